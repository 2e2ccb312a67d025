"""Raster and polygon operators on pixel tables."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaica.functions import geometry as G
from mosaica.operators import aggregates as A
from mosaica.operators.graphs import components, pixel_components
from mosaica.operators.joins import knn_join


def rasterise(rings: DataFrame, key: str = "id") -> DataFrame:
    """(key, row, col): integer pixels strictly inside each ring."""
    b = rings.select(key, "ring", G.ring_bbox(F.col("ring")).alias("b"))
    rows = b.select(key, "ring", "b", F.explode(F.sequence(F.floor("b.y0").cast("int"), F.ceil("b.y1").cast("int"))).alias("row"))
    px = rows.select(key, "ring", "row", F.explode(F.sequence(F.floor("b.x0").cast("int"), F.ceil("b.x1").cast("int"))).alias("col"))
    return px.where(G.point_in_ring(F.col("col").cast("double"), F.col("row").cast("double"), F.col("ring"))).select(key, "row", "col")


def rescale_labels(labels: DataFrame, ratio: float) -> DataFrame:
    """Nearest-neighbour rescale: the target pixel (r, c) takes the label at (floor(r / ratio), floor(c / ratio))."""
    span = lambda v: F.sequence(F.ceil(v * ratio).cast("int"), F.ceil((v + 1) * ratio).cast("int") - 1)
    ok = lambda v: F.ceil((v + 1) * ratio) > F.ceil(v * ratio)
    kept = labels.where(ok(F.col("row")) & ok(F.col("col")))
    return kept.withColumn("row", F.explode(span(F.col("row")))).withColumn("col", F.explode(span(F.col("col"))))


def valid_labels(labels: DataFrame, keys: list[str] = ("image_id",)) -> DataFrame:
    """(keys, label) whose pixels form one part without a hole: Euler number 1 for 4-neighbours, which is pixels - edges + full
    2 x 2 squares, together with one component."""
    keys = [*keys, "label"]
    px = labels.where("label <> 0").select(*keys, "row", "col")
    at = lambda dr, dc: px.select(*keys, (F.col("row") - dr).alias("row"), (F.col("col") - dc).alias("col"), F.lit(1).alias(f"n{dr}{dc}"))
    on = [*keys, "row", "col"]
    near = px.join(at(0, 1), on, "left").join(at(1, 0), on, "left").join(at(1, 1), on, "left")
    square = F.when(F.col("n01").isNotNull() & F.col("n10").isNotNull() & F.col("n11").isNotNull(), 1)
    euler = near.groupBy(*keys).agg((F.count("*") - F.count("n01") - F.count("n10") + F.count(square)).alias("euler"))
    key = F.xxhash64(*keys, "row", "col")
    nodes = px.withColumn("id", key)
    east = px.join(at(0, 1), on).select(key.alias("id"), F.xxhash64(*keys, "row", F.col("col") + 1).alias("other"))
    south = px.join(at(1, 0), on).select(key.alias("id"), F.xxhash64(*keys, F.col("row") + 1, "col").alias("other"))
    parts = nodes.join(components(nodes.select("id"), east.unionByName(south)), "id").groupBy(*keys).agg(F.countDistinct("component").alias("parts"))
    return euler.join(parts, keys).where("euler = 1 and parts = 1").select(*keys)


def trace_outline(rows: Iterable[int], cols: Iterable[int]) -> list[tuple[int, int]]:
    """Corner points (x, y) of the outline of one 4-connected set of pixels without holes, closed, each pixel a unit square."""
    cells = set(zip(rows, cols))
    nxt = {}
    for r, c in cells:
        for (dr, dc), (a, b) in {(-1, 0): ((c, r), (c + 1, r)), (0, 1): ((c + 1, r), (c + 1, r + 1)), (1, 0): ((c + 1, r + 1), (c, r + 1)), (0, -1): ((c, r + 1), (c, r))}.items():
            if (r + dr, c + dc) not in cells:
                nxt.setdefault(a, []).append(b)
    start = min(nxt)
    ring, at, came = [start], nxt[start].pop(), start
    while at != start:
        ahead = (at[0] - came[0], at[1] - came[1])
        options = nxt[at]
        # where two squares touch at a corner, keep to the own one: turn right first
        step = next((o for o in options if (o[0] - at[0], o[1] - at[1]) == (-ahead[1], ahead[0])), options[0])
        options.remove(step)
        if (step[0] - at[0], step[1] - at[1]) != ahead:
            ring.append(at)
        came, at = at, step
    return [*ring, start]


def labels_to_polygons(labels: DataFrame, keys: list[str] = ("image_id",), offset: tuple[int, int] = (0, 0)) -> DataFrame:
    """(keys, label, ring): outline of each valid label, moved by (row, col) of the crop. A group is one label, small by nature."""
    keys = list(keys)
    kept = labels.where("label <> 0").join(valid_labels(labels, keys), [*keys, "label"], "left_semi")
    types = {f.name: f.dataType.simpleString() for f in labels.schema}
    schema = ", ".join(f"{k} {types[k]}" for k in [*keys, "label"]) + ", ring array<struct<x:double,y:double>>"

    def outline(pdf: pd.DataFrame) -> pd.DataFrame:
        ring = [{"x": float(x + offset[1]), "y": float(y + offset[0])} for x, y in trace_outline(pdf["row"], pdf["col"])]
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in [*keys, "label"]}, "ring": [ring]})

    return kept.groupBy(*keys, "label").applyInPandas(outline, schema)


def resample(raster: DataFrame, inverse: tuple[float, ...], rows: tuple[int, int], cols: tuple[int, int], default: float = 0.0) -> DataFrame:
    """Nearest-neighbour resample onto the grid [r0, r1) x [c0, c1); inverse (a, b, c, d, tx, ty) leads from target (x, y) to source.

    Target rows are spread over tasks before columns are generated.
    """
    a, b, c, d, tx, ty = inverse
    grid = raster.sparkSession.range(rows[0], rows[1]).select(F.col("id").cast("int").alias("row")).select("row", F.explode(F.sequence(F.lit(cols[0]), F.lit(cols[1] - 1))).alias("col"))
    sx, sy = F.round(F.col("col") * a + F.col("row") * b + tx).cast("int"), F.round(F.col("col") * c + F.col("row") * d + ty).cast("int")
    source = raster.select(F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    out = grid.withColumn("_c", sx).withColumn("_r", sy).join(source, ["_r", "_c"], "left")
    return out.select("row", "col", F.coalesce("value", F.lit(default)).alias("value"))


def target_bbox(px: DataFrame, affine: tuple[float, ...], shape: tuple[int, int]) -> DataFrame:
    """Box of the transformed extent of pixels (x, y), one pixel wider, clamped to (rows, cols)."""
    a, b, c, d, tx, ty = affine
    e = px.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    corners = e.select(F.explode(F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x in ("x0", "x1") for y in ("y0", "y1")])).alias("p"))
    t = corners.select((F.col("p.x") * a + F.col("p.y") * b + tx).alias("x"), (F.col("p.x") * c + F.col("p.y") * d + ty).alias("y"))
    return t.agg(
        F.greatest(F.floor(F.min("x")) - 1, F.lit(0)).alias("c0"), F.least(F.ceil(F.max("x")) + 1, F.lit(shape[1])).alias("c1"),
        F.greatest(F.floor(F.min("y")) - 1, F.lit(0)).alias("r0"), F.least(F.ceil(F.max("y")) + 1, F.lit(shape[0])).alias("r1"),
    )


def points_to_grid(px: DataFrame, keys: list[str] = ("sample_id",)) -> DataFrame:
    """Dense grid (keys, row, col, value) of point rows (keys, x, y, value) from the origin, 0 where nothing or NaN is."""
    keys = list(keys)
    low = px.groupBy(*keys).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    grid = low.select(*keys, "x0", "y0", F.explode(F.sequence(F.lit(0), (F.col("y1") - F.col("y0")).cast("int"))).alias("row"), (F.col("x1") - F.col("x0")).cast("int").alias("w")).select(*keys, "x0", "y0", "row", F.explode(F.sequence(F.lit(0), F.col("w"))).alias("col"))
    at = grid.withColumn("x", F.col("x0") + F.col("col")).withColumn("y", F.col("y0") + F.col("row"))
    return at.join(px, [*keys, "x", "y"], "left").select(*keys, "row", "col", F.coalesce(F.nanvl("value", F.lit(None).cast("double")), F.lit(0.0)).alias("value"))


BLOCK = 64  # side of the blocks by which pixels are dealt before they are spread


def footprint(px: DataFrame, step: int) -> DataFrame:
    """(row, col, value): each pixel (seq, row, col, value) fills the block of half a step around it; the larger seq wins.

    Pixels are dealt to many tasks by blocks of the plane first: a file of few bytes is read by few tasks, which would hold all that its pixels spread to, and neighbours that
    meet in a task are merged there."""
    h, spark = step // 2, px.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    dealt = px.repartition(tasks, F.floor(F.col("row") / BLOCK), F.floor(F.col("col") / BLOCK))
    wide = dealt.withColumn("row", F.explode(F.sequence(F.col("row") - h, F.col("row") + h))).withColumn("col", F.explode(F.sequence(F.col("col") - h, F.col("col") + h)))
    return wide.groupBy("row", "col").agg(F.max_by("value", "seq").alias("value"))


def pyramid(raster: DataFrame, levels: int) -> DataFrame:
    """(level, row, col, value): every 2**level-th pixel."""
    out = raster.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))).withColumn("s", F.pow(F.lit(2), F.col("level")).cast("int"))
    kept = out.where((F.col("row") % F.col("s") == 0) & (F.col("col") % F.col("s") == 0))
    return kept.withColumn("row", (F.col("row") / F.col("s")).cast("int")).withColumn("col", (F.col("col") / F.col("s")).cast("int")).drop("s")


def index_slice(px: DataFrame) -> DataFrame:
    return px.withColumn("value", F.col("ims_idx").cast("double"))


def checker_slice(px: DataFrame) -> DataFrame:
    return px.withColumn("value", F.when(F.pmod("row", F.lit(2)) != F.pmod("col", F.lit(2)), 2.0).otherwise(1.0))


def grid_displacement(spark, shape: tuple[int, int], affine: tuple[float, ...], pitch: int = 20) -> DataFrame:
    """(row, col, displacement) of a regular grid of control points under an affine."""
    a, b, c, d, tx, ty = affine
    g = spark.range(0, shape[0], pitch).select(F.col("id").alias("row")).select("row", F.explode(F.sequence(F.lit(0), F.lit(shape[1] - 1), F.lit(pitch))).alias("col"))
    x, y = F.col("col"), F.col("row")
    return g.withColumn("displacement", F.hypot(x * a + y * b + tx - x, x * c + y * d + ty - y))


def lattice_boundary(px: DataFrame, keys: list[str] = ("sample_id",)) -> DataFrame:
    """Grid points with a missing 4-neighbour, numbered (seq) by their angle around the region's centre; exact for star-shaped regions."""
    from pyspark.sql.window import Window

    from mosaica.operators.joins import lattice_neighbours

    keys = list(keys)
    full = lattice_neighbours(px, keys=keys).groupBy(*keys, "ims_idx").agg(F.count("*").alias("n")).where("n = 4")
    edge = px.join(full, [*keys, "ims_idx"], "left_anti")
    mid = px.groupBy(*keys).agg(F.avg("ims_x").alias("_mx"), F.avg("ims_y").alias("_my"))
    turned = edge.join(mid, keys).withColumn("angle", F.atan2(F.col("ims_y") - F.col("_my"), F.col("ims_x") - F.col("_mx")))
    return turned.withColumn("seq", F.row_number().over(Window.partitionBy(*keys).orderBy("angle", "ims_idx")) - 1).drop("_mx", "_my")


def dedupe_regions(pixels: DataFrame, threshold: float = 0.98) -> DataFrame:
    """Ids of the regions (id, row, col) that stay: of regions linked by a Dice above the threshold the largest, smallest id on ties."""
    n = pixels.groupBy("id").agg(F.count("*").alias("n"))
    other = pixels.withColumnRenamed("id", "other")
    meet = pixels.join(other, ["row", "col"]).where("id < other").groupBy("id", "other").agg(F.count("*").alias("m"))
    linked = meet.join(n, "id").join(n.withColumnsRenamed({"id": "other", "n": "n2"}), "other").where(2 * F.col("m") / (F.col("n") + F.col("n2")) > threshold)
    groups = components(n.select("id"), linked.select("id", "other")).join(n, "id")
    return groups.groupBy("component").agg(F.max_by("id", F.struct("n", -F.col("id"))).alias("id")).select("id")


def region_moments(pixels: DataFrame, key: str = "id") -> DataFrame:
    """Area, centroid and the seven Hu invariants of regions (key, row, col)."""
    m = pixels.groupBy(key).agg(F.count("*").cast("double").alias("area"), F.avg("col").alias("cx"), F.avg("row").alias("cy"))
    x, y = F.col("col") - F.col("cx"), F.col("row") - F.col("cy")
    orders = [(2, 0), (1, 1), (0, 2), (3, 0), (2, 1), (1, 2), (0, 3)]
    power = lambda v, k: F.lit(1.0) if k == 0 else F.pow(v, F.lit(float(k)))
    c = pixels.join(m, key).groupBy(key, "area", "cx", "cy").agg(*[F.sum(power(x, p) * power(y, q)).alias(f"m{p}{q}") for p, q in orders])
    c = c.select(key, "area", "cx", "cy", *[(F.col(f"m{p}{q}") / F.pow("area", F.lit(1 + (p + q) / 2))).alias(f"n{p}{q}") for p, q in orders])
    n = {f"{p}{q}": F.col(f"n{p}{q}") for p, q in orders}
    s, t = n["30"] + n["12"], n["21"] + n["03"]
    u, v = n["30"] - 3 * n["12"], 3 * n["21"] - n["03"]
    hu = [
        n["20"] + n["02"], (n["20"] - n["02"]) * (n["20"] - n["02"]) + 4 * n["11"] * n["11"], u * u + v * v, s * s + t * t,
        u * s * (s * s - 3 * t * t) + v * t * (3 * s * s - t * t), (n["20"] - n["02"]) * (s * s - t * t) + 4 * n["11"] * s * t,
        v * s * (s * s - 3 * t * t) - u * t * (3 * s * s - t * t),
    ]
    return c.select(key, "area", "cx", "cy", *[h.alias(f"hu{i + 1}") for i, h in enumerate(hu)])


def shape_distance(pairs: DataFrame, moments: DataFrame) -> DataFrame:
    """pairs (id, other) with the sum of absolute differences of sign * log10 of the Hu invariants."""
    hu = [f"hu{i}" for i in range(1, 8)]
    level = lambda c: F.when(F.abs(c) > 1e-30, F.signum(c) * F.log10(F.abs(c))).otherwise(0.0)
    m = moments.select("id", *[level(F.col(h)).alias(h) for h in hu])
    o = m.select(F.col("id").alias("other"), *[F.col(h).alias(f"_{h}") for h in hu])
    j = pairs.join(m, "id").join(o, "other")
    total = sum((F.abs(F.col(h) - F.col(f"_{h}")) for h in hu), F.lit(0.0))
    return j.withColumn("shape_distance", total).drop(*hu, *[f"_{h}" for h in hu])


def background_distance(labels: DataFrame, reach: float) -> DataFrame:
    """Quantiles of the distance of background pixels to the nearest labelled pixel within reach; only labelled pixels at an edge are joined."""
    on = labels.where("label <> 0").select("row", "col")
    inner = on
    for dr, dc in ((0, 1), (0, -1), (1, 0), (-1, 0)):
        inner = inner.join(on.select((F.col("row") + dr).alias("row"), (F.col("col") + dc).alias("col")), ["row", "col"], "left_semi")
    ids = lambda df: df.select(F.xxhash64("row", "col").alias("id"), F.col("col").cast("double").alias("x"), F.col("row").cast("double").alias("y"))
    near = knn_join(ids(labels.where("label = 0")), ids(on.join(inner, ["row", "col"], "left_anti")), 1, max_dist=reach)
    return A.error_summary(near, [], "d")


def tissue_guard(metrics: DataFrame, fraction: str, lower: float, upper: float, cols: list[str]) -> DataFrame:
    ok = F.col(fraction).between(lower, upper)
    return metrics.withColumns({c: F.when(ok, F.col(c)) for c in cols})


def detect_marks(raster: DataFrame, threshold: float, pixel: float, resolution: float, step: float, radius: float, least: int = 6) -> DataFrame:
    """Marks (component, x, y in steps, area): bright components of plausible area and shape; empty unless at least `least` remain."""
    on = raster.where(F.col("value") > threshold).select("row", "col")
    p = A.label_props(pixel_components(on, diagonal=True).withColumnRenamed("component", "label"))
    h, w = F.col("r1") - F.col("r0") + 1, F.col("c1") - F.col("c0") + 1
    good = p.where(F.col("area").between(3.141592653589793 * radius * radius, (pixel / resolution) ** 2) & (F.greatest(h / w, w / h) < 2))
    n = good.agg(F.count("*").alias("_n"))
    out = good.crossJoin(F.broadcast(n)).where(F.col("_n") >= least)  # one row
    return out.select(F.col("label").alias("component"), (F.col("c_col") * resolution / step).alias("x"), (F.col("c_row") * resolution / step).alias("y"), "area")
