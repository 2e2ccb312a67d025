"""Window functions, ordering, limits and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def index_rows(df: DataFrame, keys: list[str], order: str, out: str = "idx") -> DataFrame:
    """Rows of each group numbered from 0."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)


def pixel_weights(df: DataFrame) -> DataFrame:
    """total_filled of the pixel, weight of the cell in it (1 where nothing is filled) and scaling cell area / total."""
    total = F.sum("filled_area").over(Window.partitionBy("ims_idx", "sample_id"))
    out = df.withColumn("total_filled", total)
    return out.withColumn("weight", F.when(F.col("total_filled") > 0, F.col("filled_area") / F.col("total_filled")).otherwise(1.0)).withColumn("scaling", F.col("cell_area") / F.when(F.col("total_filled") > 0, F.col("total_filled")))


def drop_rare_types(df: DataFrame, most: int = 2, col: str = "celltype") -> DataFrame:
    """Without the rows of types that have at most `most` rows. A join on few counts, since one type may hold most rows."""
    rare = df.groupBy(col).agg(F.count("*").alias("_n")).where(F.col("_n") <= most).select(col)
    return df.join(rare, col, "left_anti")


def cells_per_pixel(df: DataFrame) -> DataFrame:
    """The number of cells of the row's pixel beside every row."""
    return df.withColumn("n_cells", F.count("cell_idx").over(Window.partitionBy("sample_id", "ims_idx")))


def fill_updown(df: DataFrame, cols: list[str], keys: list[str], order: str) -> DataFrame:
    """Nulls take the next value of the group, or else the last one."""
    # both frames grow row by row; one that shrinks would be gone through again for every row
    after = Window.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.coalesce(c, F.last(c, ignorenulls=True).over(after), F.last(c, ignorenulls=True).over(before)) for c in cols})


def share(df: DataFrame, n: str, keys: list[str], out: str = "share") -> DataFrame:
    """Share of a value in its group's sum."""
    return df.withColumn(out, F.col(n) / F.sum(n).over(Window.partitionBy(*keys)))


def fdr(df: DataFrame, p: str, keys: list[str], out: str = "fdr") -> DataFrame:
    """Benjamini-Hochberg within groups; a null p stays null and does not count."""
    g = Window.partitionBy(*keys)
    ranked = df.withColumn("_n", F.count(p).over(g)).withColumn("_r", F.rank().over(g.orderBy(F.col(p).asc_nulls_last())))
    ties = ranked.withColumn("_r", F.col("_r") + F.count(p).over(Window.partitionBy(*keys, p)) - 1)
    raw = ties.withColumn("_q", F.least(F.lit(1.0), F.col(p) * F.col("_n") / F.col("_r")))
    run = Window.partitionBy(*keys).orderBy(F.col(p).desc_nulls_last()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return raw.withColumn(out, F.when(F.col(p).isNotNull(), F.min("_q").over(run))).drop("_n", "_r", "_q")


def circular_ngrams(points: DataFrame, before: int, after: int, keys: list[str], order: str = "seq", value: str = "code") -> DataFrame:
    """Each point of a closed line with the values from `before` points before to `after` points after it, as an array."""
    g = Window.partitionBy(*keys)
    numbered = points.withColumn("_i", F.row_number().over(g.orderBy(order))).withColumn("_n", F.count("*").over(g))
    copies = numbered.withColumn("_t", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).where((F.col("_t") == 0) | ((F.col("_t") < 0) & (F.col("_i") > F.col("_n") - before)) | ((F.col("_t") > 0) & (F.col("_i") <= after)))
    w = Window.partitionBy(*keys).orderBy(F.col("_i") + F.col("_t") * F.col("_n")).rowsBetween(-before, after)
    return copies.withColumn("ngram", F.collect_list(value).over(w)).where("_t = 0").drop("_i", "_n", "_t")


def direction_codes(points: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """L, B, R or T: the quarter that the step to the next point (the first after the last) points to, y downwards."""
    w = Window.partitionBy(*keys).orderBy(order)
    whole = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nx, ny = F.coalesce(F.lead("x").over(w), F.first("x").over(whole)), F.coalesce(F.lead("y").over(w), F.first("y").over(whole))
    quarter = F.pmod(F.round(F.degrees(F.atan2(ny - F.col("y"), nx - F.col("x"))) / 90).cast("int"), F.lit(4))
    return points.withColumn("code", F.get(F.array(*[F.lit(c) for c in "RBLT"]), quarter))


def valid_steps(points: DataFrame, keys: list[str], order: str = "seq", before: int = 0, after: int = 0, tol: float = 0.2, angle: float = 15.0) -> DataFrame:
    """Whether all steps in the window have length 1 within tol and lie within an angle of an axis."""
    w = Window.partitionBy(*keys).orderBy(order)
    dx, dy = F.lead("x").over(w) - F.col("x"), F.lead("y").over(w) - F.col("y")
    turn = F.degrees(F.atan2(dy, dx))
    ok = F.coalesce((F.abs(F.hypot(dx, dy) - 1) <= tol) & (F.abs(turn - F.round(turn / 90) * 90) <= angle), F.lit(True))
    return points.withColumn("_ok", ok).withColumn("valid", F.min("_ok").over(w.rowsBetween(-before, after))).drop("_ok")


def max_angular_gap(points: DataFrame, keys: list[str]) -> DataFrame:
    """Largest angle in degrees between neighbouring directions from the group's centroid."""
    g = Window.partitionBy(*keys)
    a = points.withColumn("_a", F.degrees(F.atan2(F.col("y") - F.avg("y").over(g), F.col("x") - F.avg("x").over(g))))
    w = Window.partitionBy(*keys).orderBy("_a")
    gaps = a.withColumn("_g", F.coalesce(F.col("_a") - F.lag("_a").over(w), F.col("_a") + 360 - F.max("_a").over(g)))
    return gaps.groupBy(*keys).agg(F.max("_g").alias("gap"))


def ssim(img1: DataFrame, img2: DataFrame, data_range: float = 1.0, size: int = 7) -> DataFrame:
    """Mean structural similarity over the interior of two dense images, uniform window, sample covariance, K1 0.01, K2 0.03.

    Sums over the window are taken along rows, then along columns.
    """
    h = size // 2
    both = img1.select("row", "col", F.col("value").alias("x")).join(img2.select("row", "col", F.col("value").alias("y")), ["row", "col"])
    names = ["x", "y", "xx", "yy", "xy"]
    both = both.select("row", "col", "x", "y", (F.col("x") * F.col("x")).alias("xx"), (F.col("y") * F.col("y")).alias("yy"), (F.col("x") * F.col("y")).alias("xy"), F.lit(1).alias("n"))
    for part, order in (("row", "col"), ("col", "row")):
        w = Window.partitionBy(part).orderBy(order).rowsBetween(-h, h)
        both = both.withColumns({c: F.sum(c).over(w) for c in [*names, "n"]})
    n = float(size * size)
    inside = both.where(F.col("n") == size * size).select(*[(F.col(c) / n).alias(c) for c in names])
    k = n / (n - 1)
    vx, vy, vxy = (k * (F.col("xx") - F.col("x") * F.col("x")), k * (F.col("yy") - F.col("y") * F.col("y")), k * (F.col("xy") - F.col("x") * F.col("y")))
    c1, c2 = (0.01 * data_range) ** 2, (0.03 * data_range) ** 2
    s = ((2 * F.col("x") * F.col("y") + c1) * (2 * vxy + c2)) / ((F.col("x") * F.col("x") + F.col("y") * F.col("y") + c1) * (vx + vy + c2))
    return inside.agg(F.avg(s).alias("ssim"))


def dilate(mask: DataFrame, size: int) -> DataFrame:
    """Mask (row, col) grown by a square of side `size`, along rows, then along columns."""
    h = size // 2
    for c in ("row", "col"):
        mask = mask.withColumn(c, F.explode(F.sequence(F.col(c) - h, F.col(c) + h))).distinct()
    return mask


def erode(mask: DataFrame, size: int) -> DataFrame:
    """Pixels whose whole square lies in the mask: what the grown complement does not reach."""
    ring = dilate(mask, 2 * (size // 2) + 1).join(mask, ["row", "col"], "left_anti")
    return mask.join(dilate(ring, size), ["row", "col"], "left_anti")


def ring_mask(mask: DataFrame, outside: int, inside: int) -> DataFrame:
    """The grown mask without the shrunk one."""
    return dilate(mask, outside).join(erode(mask, inside), ["row", "col"], "left_anti")


def normalise_origin(px: DataFrame, keys: list[str] = ("sample_id",)) -> DataFrame:
    """x, y moved so that each group starts at 0."""
    low = px.groupBy(*keys).agg(F.min("x").alias("_x"), F.min("y").alias("_y"))
    return px.join(low, list(keys)).withColumn("x", F.col("x") - F.col("_x")).withColumn("y", F.col("y") - F.col("_y")).drop("_x", "_y")


def top_fraction(df: DataFrame, score: str, frac: float = 0.9) -> DataFrame:
    """Rows whose score reaches a share of the best, best first."""
    top = df.agg(F.max(score).alias("_top"))
    return df.crossJoin(F.broadcast(top)).where(F.col(score) >= frac * F.col("_top")).drop("_top").orderBy(F.col(score).desc())  # one row


def top_n(df: DataFrame, score: str, n: int, largest: bool = False) -> DataFrame:
    """The n candidates of smallest score, or of largest for parity."""
    return df.orderBy(F.col(score).desc() if largest else F.col(score).asc()).limit(n)


def quantile_cut(df: DataFrame, col: str, q: float) -> DataFrame:
    """Rows whose value reaches the column's quantile."""
    from mosaica.operators.aggregates import table_quantile

    cutoff = table_quantile(df, col, q, "_q")
    return df.crossJoin(F.broadcast(cutoff)).where(F.col(col) >= F.col("_q")).drop("_q")  # one row


def sample_cap(df: DataFrame, n: int, seed: int, *key: str) -> DataFrame:
    """n rows by a hash of the key and a seed: the same on any partitioning."""
    return df.orderBy(F.xxhash64(*[F.col(k) for k in key], F.lit(seed)), *key).limit(n)


def composite_best(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Best candidate of each group among those whose coverage reaches the 0.995 quantile, by the sum of scaled coverage, matches and
    inverted weighted distance; a constant criterion counts 1. `identity` says that the best coverage is below 0.95."""
    from mosaica.operators.aggregates import grouped_quantiles, join_safe

    q = grouped_quantiles(candidates, keys, {"_q": (F.col("coverage"), 0.995)})
    kept = join_safe(candidates, q, keys, "inner").where("coverage >= _q").drop("_q")
    w = Window.partitionBy(*keys)
    scaled = lambda x: F.when(F.max(x).over(w) > F.min(x).over(w), (F.col(x) - F.min(x).over(w)) / (F.max(x).over(w) - F.min(x).over(w))).otherwise(1.0)
    flipped = F.when(F.max("weighted_distance").over(w) > F.min("weighted_distance").over(w), 1 - scaled("weighted_distance")).otherwise(1.0)
    scored = kept.withColumn("score", scaled("coverage") + scaled("n_matches") + flipped)
    best = scored.withColumn("_r", F.row_number().over(w.orderBy(F.col("score").desc(), "candidate"))).where("_r = 1").drop("_r")
    return best.withColumn("identity", F.col("coverage") < 0.95)


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """All rows of all tables by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_pixels(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct rows of the columns."""
    return df.select(*cols).distinct()


def name_mismatch(a: DataFrame, b: DataFrame) -> DataFrame:
    """Names that only one side has, sorted; should be empty."""
    return a.select("name").exceptAll(b.select("name")).unionAll(b.select("name").exceptAll(a.select("name"))).orderBy("name")


def common_samples(a: DataFrame, b: DataFrame, key: str = "sample_id") -> DataFrame:
    """Samples of both tables."""
    return a.select(key).intersect(b.select(key))


def presence(df: DataFrame, types: list[str], col: str = "type") -> DataFrame:
    """For each expected type whether the table has it."""
    expected = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(t) for t in types])).alias(col))
    return expected.join(df.select(col).distinct().withColumn("_h", F.lit(True)), col, "left").select(col, F.coalesce("_h", F.lit(False)).alias("exists"))
