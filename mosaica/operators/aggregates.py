"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mosaica.operators.lineage import cut

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def tic(spectra: DataFrame, key: str = "ims_idx") -> DataFrame:
    """Total intensity and number of features of each pixel."""
    return spectra.groupBy(key).agg(F.sum("intensity").alias("tic"), F.count("*").alias("n_features"))


def bin_peaks(aligned: DataFrame, key: str = "ims_idx", value: str = "intensity") -> DataFrame:
    """Largest value per pixel and reference m/z."""
    return aligned.groupBy(key, F.col("ref").alias("mz")).agg(F.max(value).alias("value"))


def label_means(labels: DataFrame, raster: DataFrame, channels: list[int] | None = None, keys: list[str] = ()) -> DataFrame:
    """Mean value of each channel per label (and keys, which both tables hold), one column a channel; labels without raster pixels keep nulls."""
    keys = list(keys)
    inside = labels.where("label <> 0")
    long = inside.join(raster, [*keys, "row", "col"], "left").groupBy(*keys, "label")
    return (long.pivot("channel", channels) if channels else long.pivot("channel")).agg(F.avg("value"))


def label_props(labels: DataFrame) -> DataFrame:
    """Area, centroid and box of each label but 0."""
    return labels.where("label <> 0").groupBy("label").agg(
        F.count("*").alias("area"), F.avg("row").alias("c_row"), F.avg("col").alias("c_col"),
        F.min("row").alias("r0"), F.min("col").alias("c0"), F.max("row").alias("r1"), F.max("col").alias("c1"),
    )


def majority_label(a: DataFrame, b: DataFrame) -> DataFrame:
    """For each label of a the most frequent non-zero label of b on its pixels, the smallest on ties."""
    both = a.where("label <> 0").select("row", "col", "label").join(b.where("label <> 0").select("row", "col", F.col("label").alias("other")), ["row", "col"])
    return both.groupBy("label", "other").agg(F.count("*").alias("n")).groupBy("label").agg(F.max_by("other", F.struct("n", -F.col("other"))).alias("other"), F.max("n").alias("n"))


def corner_label(boxes: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, label): the label under all four corners of a box (id, r0, c0, r1, c1), null unless it is one and not 0."""
    corners = F.array(*[F.struct(F.col(r).alias("row"), F.col(c).alias("col")) for r in ("r0", "r1") for c in ("c0", "c1")])
    at = boxes.select("id", F.explode(corners).alias("p")).select("id", "p.row", "p.col").join(labels.select("row", "col", "label"), ["row", "col"], "left")
    g = at.groupBy("id").agg(F.collect_set(F.coalesce("label", F.lit(0))).alias("s"))
    return g.select("id", F.when((F.size("s") == 1) & (F.get("s", F.lit(0)) != 0), F.get("s", F.lit(0))).alias("label"))


def union_bbox(boxes: DataFrame, margin: float, shape: tuple[float, float], keys: list[str] = ()) -> DataFrame:
    """Box around all boxes of a group with a margin, within the image (rows, columns)."""
    return boxes.groupBy(*keys).agg(
        F.greatest(F.min("r0") - margin, F.lit(0.0)).alias("r0"), F.greatest(F.min("c0") - margin, F.lit(0.0)).alias("c0"),
        F.least(F.max("r1") + margin, F.lit(float(shape[0]))).alias("r1"), F.least(F.max("c1") + margin, F.lit(float(shape[1]))).alias("c1"),
    )


def join_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """a joined with b on keys, where null equals null; without keys b is one row."""
    if not keys:
        return a.crossJoin(F.broadcast(b))
    b = b.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return a.join(b, on, how).drop(*[f"_k{i}" for i in range(len(keys))])


def grouped_quantiles(df: DataFrame, keys: list[str], quantiles: dict[str, tuple[Column, float]]) -> DataFrame:
    """(keys, one column a quantile): exact quantiles with linear interpolation of each group, by {name: (value, q)}.

    Values are counted, sorted in ranges of (keys, value), and only the sizes of (range, group) meet, so a group that holds most rows spreads over
    as many ranges as it needs. Null values do not count, NaN is the largest; a group without values has no row; a null key is a group of its own.
    Quantiles of several values of a row are found in one pass, each value marked by its own number.
    """
    values = {str(v): v for v, _ in quantiles.values()}
    which = {name: list(values).index(str(v)) for name, (v, _) in quantiles.items()}
    keys, g = list(keys), [*keys, "_i"]
    long = df.select(*keys, F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), v.cast("double").alias("_v")) for i, v in enumerate(values.values())])).alias("_e"))
    counted = long.select(*keys, "_e._i", "_e._v").where("_v is not null").groupBy(*g, "_v").agg(F.count("*").alias("_n"))
    ranged = cut(counted.repartitionByRange(*g, "_v").withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part", *g).agg(F.sum("_n").alias("_size"))
    whole = Window.partitionBy(*g)  # a row a range
    before = sizes.select("_part", *g, (F.sum("_size").over(whole.orderBy("_part")) - F.col("_size")).alias("_before"), F.sum("_size").over(whole).alias("_total"))
    inside = F.sum("_n").over(Window.partitionBy("_part", *g).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1))
    run = join_safe(ranged.withColumn("_inside", F.coalesce(inside, F.lit(0))), before, ["_part", *g]).withColumn("_lo", F.col("_before") + F.col("_inside"))
    at = {name: F.lit(q) * (F.col("_total") - 1) for name, (_, q) in quantiles.items()}
    pick = lambda name, rank: F.max(F.when((F.col("_i") == which[name]) & (F.col("_lo") <= rank) & (rank < F.col("_lo") + F.col("_n")), F.col("_v")))
    found = run.groupBy(*keys).agg(*[x for n in quantiles for x in (
        pick(n, F.floor(at[n])).alias(f"_a_{n}"), pick(n, F.ceil(at[n])).alias(f"_b_{n}"), F.max(F.when(F.col("_i") == which[n], at[n] - F.floor(at[n]))).alias(f"_f_{n}"))])
    # equal neighbours give their value, infinite ones too
    between = lambda n: F.when(F.col(f"_a_{n}") == F.col(f"_b_{n}"), F.col(f"_a_{n}")).otherwise(F.col(f"_a_{n}") + F.col(f"_f_{n}") * (F.col(f"_b_{n}") - F.col(f"_a_{n}")))
    return found.select(*keys, *[between(n).alias(n) for n in quantiles])


def _summaries(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    plain = [f for p, v in values.items() for f in (F.avg(v).alias(f"{p}mean"), F.min(v).alias(f"{p}min"), F.max(v).alias(f"{p}max"), F.count(v).alias(f"{p}n"))]
    names = {p: {f"{p}q{int(q * 100):02d}": (v, q) for q in QUANTILES} for p, v in values.items()}
    out = join_safe(df.groupBy(*keys).agg(*plain), grouped_quantiles(df, keys, {n: x for own in names.values() for n, x in own.items()}), keys)
    return out.select(*keys, *[c for p in values for c in (f"{p}mean", f"{p}min", f"{p}max", f"{p}n", *names[p])])


def error_summary(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Mean, least, greatest, number and exact quantiles with linear interpolation; all but the number are null for a group of nulls."""
    return _summaries(df, list(keys), {"": F.col(col)})


def error_summary_masked(df: DataFrame, keys: list[str], col: str, mask: str) -> DataFrame:
    """The same overall and, with the prefix masked_, for the rows in the mask, in one pass."""
    return _summaries(df, list(keys), {"": F.col(col), "masked_": F.when(F.col(mask), F.col(col))})


def dice(m1: DataFrame, m2: DataFrame) -> DataFrame:
    """Dice of two masks, tables of distinct (row, col)."""
    both = m1.select("row", "col").distinct().withColumn("a", F.lit(1)).join(m2.select("row", "col").distinct().withColumn("b", F.lit(1)), ["row", "col"], "full")
    return both.agg((2 * F.sum((F.col("a").isNotNull() & F.col("b").isNotNull()).cast("int")) / (F.count("a") + F.count("b"))).alias("dice"))


def max_dice(set1: DataFrame, set2: DataFrame) -> DataFrame:
    """(id, other, dice): for each mask (id, row, col) of set1 the mask of set2 with the greatest Dice among those it meets."""
    n1 = set1.groupBy("id").agg(F.count("*").alias("n1"))
    n2 = set2.groupBy(F.col("id").alias("other")).agg(F.count("*").alias("n2"))
    meet = set1.join(set2.withColumnRenamed("id", "other"), ["row", "col"]).groupBy("id", "other").agg(F.count("*").alias("n"))
    scored = meet.join(n1, "id").join(n2, "other").select("id", "other", (2 * F.col("n") / (F.col("n1") + F.col("n2"))).alias("dice"))
    return scored.groupBy("id").agg(F.max_by("other", F.struct("dice", -F.col("other"))).alias("other"), F.max("dice").alias("dice"))


def cover_fraction(a: DataFrame, b: DataFrame) -> DataFrame:
    """Share of mask a that mask b covers."""
    hit = a.select("row", "col").distinct().join(b.select("row", "col").distinct().withColumn("h", F.lit(1)), ["row", "col"], "left")
    return hit.agg((F.count("h") / F.count("*")).alias("covered"))


def image_similarity(img1: DataFrame, img2: DataFrame, bins: int = 100) -> DataFrame:
    """mse, nrmse (by the root mean square of the first) and nmi = (H(X) + H(Y)) / H(X, Y) of a joint histogram of bins x bins."""
    both = img1.select("row", "col", F.col("value").alias("x")).join(img2.select("row", "col", F.col("value").alias("y")), ["row", "col"])
    base = both.agg(F.avg(F.pow(F.col("x") - F.col("y"), F.lit(2.0))).alias("mse"), F.avg(F.col("x") * F.col("x")).alias("ms"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    at = lambda v, lo, hi: F.least(F.floor((F.col(v) - F.col(lo)) / F.greatest(F.col(hi) - F.col(lo), F.lit(1e-300)) * bins), F.lit(bins - 1))
    cells = both.crossJoin(F.broadcast(base)).groupBy(at("x", "x0", "x1").alias("i"), at("y", "y0", "y1").alias("j")).agg(F.count("*").alias("n"))  # base is one row
    total = cells.agg(F.sum("n").alias("t"))
    p = cells.crossJoin(F.broadcast(total)).select("i", "j", (F.col("n") / F.col("t")).alias("p"))  # bins**2 rows at most
    entropy = lambda df, name: df.agg((-F.sum(F.col("p") * F.ln("p"))).alias(name))
    hx, hy = (entropy(p.groupBy(k).agg(F.sum("p").alias("p")), f"h{k}") for k in "ij")
    out = base.crossJoin(hx).crossJoin(hy).crossJoin(entropy(p, "hij"))
    return out.select("mse", (F.sqrt("mse") / F.sqrt("ms")).alias("nrmse"), ((F.col("hi") + F.col("hj")) / F.col("hij")).alias("nmi"))


def table_quantile(df: DataFrame, col: str, q: float, out: str) -> DataFrame:
    """One row: the quantile of a whole column with linear interpolation, exact, without its values meeting in one task. Nulls do not count; null without values."""
    return grouped_quantiles(df, [], {out: (F.col(col), q)})


def mad(df: DataFrame, col: str) -> DataFrame:
    """(median, mad): mad is 1.4826 times the median absolute deviation."""
    m = table_quantile(df, col, 0.5, "median")
    off = df.crossJoin(F.broadcast(m)).select(F.abs(F.col(col) - F.col("median")).alias("_off"))  # one row
    return m.crossJoin(F.broadcast(table_quantile(off, "_off", 0.5, "_mad"))).select("median", (F.col("_mad") * 1.4826).alias("mad"))  # one row


def completeness(df: DataFrame, found: str = "n_found", expected: str = "n_expected") -> DataFrame:
    """Found over expected, null where nothing is expected."""
    return df.withColumn("completeness", F.col(found) / F.when(F.col(expected) > 0, F.col(expected)))


def pixel_cell_stats(df: DataFrame, key: str = "sample_id") -> DataFrame:
    """Pixels, cells, and mean, sd and exact median of cells a pixel."""
    per = df.groupBy(key, "ims_idx").agg(F.count("cell_idx").alias("c"))
    plain = per.groupBy(key).agg(F.count("*").alias("n_pixels"), F.sum("c").alias("n_cells"), F.avg("c").alias("mean_cells"), F.stddev_samp("c").alias("sd_cells"))
    return join_safe(plain, grouped_quantiles(per, [key], {"median_cells": (F.col("c"), 0.5)}), [key])


def pixel_total(df: DataFrame, keys: list[str] = ("ims_idx",)) -> DataFrame:
    """Sum of the values of each pixel."""
    return df.groupBy(*keys).agg(F.sum("value").alias("total"))


def multi_pixel_cells(df: DataFrame, keys: list[str] = ("sample_id", "cell_idx")) -> DataFrame:
    """Rows of the cells that lie on more than one pixel."""
    many = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return df.join(many, list(keys), "left_semi")


def filled_area(df: DataFrame, keys: list[str] = ("sample_id", "ims_idx")) -> DataFrame:
    """Area of each pixel that cells fill; a missing overlap fills nothing."""
    return df.groupBy(*keys).agg(F.sum(F.coalesce(F.col("overlap") * F.col("cell_area"), F.lit(0.0))).alias("filled"))


def missing_fraction(df: DataFrame, keys: list[str]) -> DataFrame:
    """Share of null values of each group."""
    return df.groupBy(*keys).agg(F.avg(F.col("value").isNull().cast("double")).alias("missing"))


def mean_intensity(df: DataFrame, keys: list[str] = ("sample_id", "mz")) -> DataFrame:
    """Mean of the known values of each group."""
    return df.groupBy(*keys).agg(F.avg("value").alias("mean"))


def celltype_proportions(annotation: DataFrame, types: list[str] | None = None, wide: bool = False) -> DataFrame:
    """Number and share of each cell type in its sample, long, or one column a type with 0 for absent ones."""
    n = annotation.groupBy("sample_id", "celltype").agg(F.count("*").alias("n"))
    out = n.withColumn("proportion", F.col("n") / F.sum("n").over(Window.partitionBy("sample_id")))
    if not wide:
        return out
    return out.groupBy("sample_id").pivot("celltype", types).agg(F.first("proportion")).fillna(0.0)


def to_wide(df: DataFrame, ids: list[str], names: str, types: list[str], aggregate: Column) -> DataFrame:
    """One column a name of the given list, filled with 0; rows with a null name give no column but keep their ids."""
    return df.groupBy(*ids).pivot(names, types).agg(aggregate).fillna(0.0, subset=types)


def to_long(df: DataFrame, ids: list[str], values: list[str] | None = None, name: str = "name", value: str = "value") -> DataFrame:
    """One row for each value column, nulls too."""
    return df.unpivot(ids, values or [c for c in df.columns if c not in ids], name, value)


def sample_constant_columns(df: DataFrame, key: str) -> list[str]:
    """Columns with at most one distinct value in every sample; nulls do not count. One row comes to the driver."""
    cols = [c for c in df.columns if c != key]
    per = df.groupBy(key).agg(*[F.count_distinct(F.col(c)).alias(c) for c in cols])
    top = per.agg(*[F.max(c).alias(c) for c in cols]).first()
    return [c for c in cols if (top[c] or 0) <= 1]


def position_outliers(df: DataFrame, size: float, mode: str = "axis", keys: list[str] = ("sample_id", "ims_idx")) -> DataFrame:
    """Pixels whose cells (x, y) spread over more than 4 pixel sizes, per axis or by the diagonal."""
    g = df.groupBy(*keys).agg((F.max("x") - F.min("x")).alias("dx"), (F.max("y") - F.min("y")).alias("dy"))
    far = F.greatest("dx", "dy") > 4 * size if mode == "axis" else F.hypot("dx", "dy") > 4 * size
    return g.where(far)


def axis_association(df: DataFrame, keys: list[str]) -> DataFrame:
    """Mean of corr(ims_x, x) and corr(ims_y, y), straight and with the pixel axes exchanged. Where any is below 0.5, the mirrored
    axes are meant, which turns its sign."""
    g = df.groupBy(*keys).agg(F.corr("ims_x", "x").alias("xx"), F.corr("ims_y", "y").alias("yy"), F.corr("ims_y", "x").alias("yx"), F.corr("ims_x", "y").alias("xy"))
    pick = lambda a, b: F.when((F.col(a) < 0.5) | (F.col(b) < 0.5), F.greatest((F.col(a) + F.col(b)) / 2, -(F.col(a) + F.col(b)) / 2)).otherwise((F.col(a) + F.col(b)) / 2)
    return g.select(*keys, pick("xx", "yy").alias("straight"), pick("yx", "xy").alias("exchanged"))


def axis_flipped(df: DataFrame, keys: list[str], rule: str = "threshold") -> DataFrame:
    """Whether a region's axes are exchanged: above 0.9 in exactly one orientation (null otherwise), or by the ratio of both."""
    a = axis_association(df, keys)
    s, e = F.col("straight"), F.col("exchanged")
    if rule == "threshold":
        return a.withColumn("flipped", F.when((s > 0.9) & (e <= 0.9), F.lit(False)).when((e > 0.9) & (s <= 0.9), F.lit(True)))
    return a.withColumn("flipped", F.when((F.greatest(s, e) > 0.8) & (F.abs(F.log10(F.abs(s) / F.abs(e))) > 0.30102999566398120), s > e))


HULL_PART = 4096  # points that meet in a task


def hull_of(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Counter-clockwise hull, closed, by Andrew's monotone chain; points on its edges are left out."""
    pts = sorted(set(points))
    turn = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    halves = []
    for walk in (pts, pts[::-1]):
        half: list = []
        for p in walk:
            while len(half) > 1 and turn(half[-2], half[-1], p) <= 0:
                half.pop()
            half.append(p)
        halves.append(half)
    return halves[0][:-1] + halves[1]


def convex_hull(points: DataFrame, key: str, part: int = HULL_PART) -> DataFrame:
    """(key, ring): counter-clockwise closed hull of the points (x, y) of each key; points with a null coordinate do not count.

    Points are first thinned to the lowest and highest y of every x, by aggregation. While a key has more than `part` points they are dealt into parts of about
    that many, and only each part's own hull goes on: a tree of hulls, whose last step holds at most `part` points or, for keys whose parts lose less than
    half, the hull itself."""
    import pandas as pd

    kind = points.schema[key].dataType.simpleString()
    ends = points.where("x is not null and y is not null").groupBy(key, "x").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    left = cut(ends.select(key, F.explode(F.array(F.struct(F.col("x").cast("double").alias("x"), F.col("lo").cast("double").alias("y")), F.struct(F.col("x").cast("double").alias("x"), F.col("hi").cast("double").alias("y")))).alias("p")).select(key, "p.x", "p.y").distinct())

    def thinned(pdf: pd.DataFrame) -> pd.DataFrame:
        ring = hull_of(list(zip(pdf["x"], pdf["y"])))
        return pd.DataFrame(ring, columns=["x", "y"]).assign(**{key: pdf[key].iloc[0]})[[key, "x", "y"]].drop_duplicates(["x", "y"])

    n = left.count()
    while True:
        sizes = left.groupBy(key).agg(F.ceil(F.count("*") / part).alias("_parts"))
        if (sizes.agg(F.max("_parts")).first()[0] or 0) <= 1:
            break
        dealt = join_safe(left, sizes, [key]).withColumn("_part", F.pmod(F.xxhash64("x", "y"), F.col("_parts")))
        left = cut(dealt.groupBy(key, "_part").applyInPandas(lambda pdf: thinned(pdf), f"`{key}` {kind}, x double, y double"))
        m = left.count()
        if 2 * m > n:
            break
        n = m

    def hull(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({key: [pdf[key].iloc[0]], "ring": [[{"x": x, "y": y} for x, y in hull_of(list(zip(pdf["x"], pdf["y"])))]]})

    return left.groupBy(key).applyInPandas(hull, f"`{key}` {kind}, ring array<struct<x:double,y:double>>")


def component_sizes(df: DataFrame, least: int = 0) -> DataFrame:
    """Members of each component, for those with at least so many."""
    return df.groupBy("component").agg(F.count("*").alias("size")).where(F.col("size") >= least)


def two_population_threshold(px: DataFrame) -> DataFrame:
    """t in 0..254 with the least share(edge > t) + share(centre <= t - 1); null unless that is below 1. px: population, value (0..255)."""
    n = px.groupBy("population", "value").agg(F.count("*").alias("n"))
    grid = px.sparkSession.range(255).select(F.col("id").cast("int").alias("t"))
    totals = n.groupBy("population").agg(F.sum("n").alias("total"))
    joined = grid.crossJoin(F.broadcast(n.join(totals, "population")))  # 255 x 512 rows at most
    bad = F.when((F.col("population") == "edge") & (F.col("value") > F.col("t")), F.col("n") / F.col("total")).when((F.col("population") == "centre") & (F.col("value") <= F.col("t") - 1), F.col("n") / F.col("total")).otherwise(0.0)
    best = joined.groupBy("t").agg(F.sum(bad).alias("error")).agg(F.min(F.struct(F.round("error", 12).alias("error"), "t")).alias("b"))
    return best.select(F.when(F.col("b.error") < 1, F.col("b.t")).alias("threshold"), F.col("b.error").alias("error"))


def missing_vs_estimate(fit: DataFrame, missing: DataFrame) -> DataFrame:
    """Correlation over m/z of the share of missing values with the estimate, for each cell type."""
    return fit.join(missing, "mz").groupBy("celltype").agg(F.corr("missing", "estimate").alias("correlation"))


def standardise(df: DataFrame, col: str, keys: list[str], out: str = "z") -> DataFrame:
    """Values less their group's mean, over its sample standard deviation. The figures of a group meet its rows in a join, so no task holds a group."""
    figures = df.groupBy(*keys).agg(F.avg(col).alias("_mean"), F.stddev_samp(col).alias("_sd"))
    return join_safe(df, figures, keys, "inner").withColumn(out, (F.col(col) - F.col("_mean")) / F.col("_sd")).drop("_mean", "_sd")
