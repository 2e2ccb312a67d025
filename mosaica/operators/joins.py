"""Joins: spatial, nearest neighbour, band and keyed. Spatial joins are equi-joins on grid cells, so Spark can split dense ones."""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mosaica.functions import geometry as G
from mosaica.operators.neighbours import nearest, placed


def _bucket(df: DataFrame, x, y, side: float) -> DataFrame:
    return df.withColumn("_bx", F.floor(x / side)).withColumn("_by", F.floor(y / side))


def _around(df: DataFrame, x, y, side: float) -> DataFrame:
    """Every row in its own grid cell and the eight around it."""
    near = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    df = df.withColumn("_bx", F.explode(F.transform(near, lambda d: F.floor(x / side) + d)))
    return df.withColumn("_by", F.explode(F.transform(near, lambda d: F.floor(y / side) + d)))


def pixel_positions(coords: DataFrame, spacing: float) -> DataFrame:
    """x, y in micrometres: physical where known, else padded grid times spacing."""
    return coords.withColumn("x", F.coalesce("x_um", F.col("x_pad") * spacing)).withColumn("y", F.coalesce("y_um", F.col("y_pad") * spacing))


def cell_pixel_overlap(cells: DataFrame, pixels: DataFrame, spacing: float, shrink: float = 1.0, max_dist: float = 100.0, single_shrink: bool = False) -> DataFrame:
    """(sample_id, cell_idx, ims_idx, overlap, cell_area) where a cell's ring meets a pixel's box.

    cells: sample_id, cell_idx, ring; pixels: sample_id, ims_idx, x, y (corner). A box has side spacing * shrink and is shrunk about its
    centre once more unless single_shrink. Only pairs with centroids closer than max_dist count. Rings without area meet nothing.
    """
    side = spacing * shrink
    inner = side if single_shrink else side * shrink
    r = F.lit(inner / 2)
    # exploding an array of one element keeps the filters that joins infer above it, so a ring's figures are computed once
    figures = F.struct(G.ring_area(F.col("ring")).alias("a"), G.ring_centroid(F.col("ring")).alias("c"), G.ring_bbox(F.col("ring")).alias("b"))
    c = cells.select("sample_id", "cell_idx", "ring", F.explode(F.array(figures)).alias("_f")).where("_f.a > 0")
    c = c.select("sample_id", "cell_idx", "ring", F.col("_f.a").alias("_a"), F.col("_f.c.x").alias("_cx"), F.col("_f.c.y").alias("_cy"), F.col("_f.b").alias("_b"))
    # a cell meets the centres of pixels in its box, half a side wider: on buckets of one spacing some four of them
    span = lambda lo, hi: F.explode(F.sequence(F.floor((lo - r) / spacing), F.floor((hi + r) / spacing)))
    c = c.withColumn("_bx", span(F.col("_b.x0"), F.col("_b.x1"))).withColumn("_by", span(F.col("_b.y0"), F.col("_b.y1")))
    p = pixels.select("sample_id", "ims_idx", (F.col("x") + side / 2).alias("_px"), (F.col("y") + side / 2).alias("_py"))
    p = _bucket(p, F.col("_px"), F.col("_py"), spacing)
    near = F.hypot(F.col("_cx") - F.col("_px"), F.col("_cy") - F.col("_py")) < max_dist
    meets = (F.col("_b.x0") < F.col("_px") + r) & (F.col("_b.x1") > F.col("_px") - r) & (F.col("_b.y0") < F.col("_py") + r) & (F.col("_b.y1") > F.col("_py") - r)
    area = G.box_overlap_area(F.col("ring"), F.col("_px") - r, F.col("_py") - r, F.col("_px") + r, F.col("_py") + r)
    pairs = c.join(p, ["sample_id", "_bx", "_by"]).where(near & meets)
    out = pairs.select("sample_id", "cell_idx", "ims_idx", F.explode(F.array(area / F.col("_a"))).alias("overlap"), F.col("_a").alias("cell_area"))
    return out.where("overlap > 0")


def join_cell_centroids(overlaps: DataFrame, centroids: DataFrame) -> DataFrame:
    return overlaps.join(centroids, ["sample_id", "cell_idx"])


def join_pixels(cells: DataFrame, pixels: DataFrame, keys: list[str], how: str = "right") -> DataFrame:
    """Cells on their pixels; every pixel stays (how='right') or only those with cells ('inner')."""
    return cells.join(pixels, keys, how)


def join_marker_means(df: DataFrame, markers: DataFrame) -> DataFrame:
    return df.join(markers.withColumnRenamed("label", "ims_idx"), ["sample_id", "ims_idx"], "left")


def join_annotation(df: DataFrame, annotation: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    return df.join(annotation, keys, how)


def join_coords_peaks(coords: DataFrame, peaks: DataFrame) -> DataFrame:
    """Coordinates and peaks (x, y) that share the original grid position."""
    return coords.join(peaks.withColumnsRenamed({"x": "x_orig", "y": "y_orig"}), ["x_orig", "y_orig"])


def match_pixels(pixels: DataFrame, coords: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Pixels (keys, x, y) whose position is among the coordinates, with axes swapped if only that finds as many as there are coordinates;
    with keys, each group is held against its own coordinates and swapped or not by itself."""
    keys = list(keys)
    at = coords.select(*keys, "x", "y").distinct()
    straight = pixels.join(at, [*keys, "x", "y"], "left_semi")
    swapped = pixels.join(at.select(*keys, F.col("y").alias("x"), F.col("x").alias("y")), [*keys, "x", "y"], "left_semi")
    if not keys:
        n = at.count()
        return straight if straight.count() == n or swapped.count() != n else swapped
    count = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    found = count(at, "_n").join(count(swapped, "_swapped"), keys).join(count(straight, "_straight"), keys, "left")
    turned = found.where("_swapped = _n and coalesce(_straight, 0) <> _n").select(*keys)
    return straight.join(turned, keys, "left_anti").unionByName(swapped.join(turned, keys, "left_semi"))


def reindex_region(pixels: DataFrame, matched: DataFrame, radius: float = 3.0) -> DataFrame:
    """Pixels (ims_idx, x, y) of the regions that hold a matched pixel, with new_idx from 0 in the order of ims_idx."""
    from mosaica.operators.graphs import pixel_regions
    from mosaica.operators.windows import index_rows

    placed = pixels.join(unbroadcast(pixel_regions(pixels, radius)), "ims_idx")
    wanted = placed.join(unbroadcast(matched.select("x", "y").distinct()), ["x", "y"], "left_semi").select("region").distinct()
    return index_rows(placed.join(unbroadcast(wanted), "region", "left_semi").withColumn("_all", F.lit(1)), ["region"], "ims_idx", "new_idx").drop("_all")


def coords_in_reference(image: DataFrame, reference: DataFrame, angle: int) -> DataFrame:
    from mosaica.operators.transforms import rotate_coords

    return rotate_coords(image, angle).join(reference.select("x", "y").distinct(), ["x", "y"], "left_semi")


def match_locations(inner: DataFrame, outer: DataFrame, frac: float = 0.99, tile: float = 1000.0) -> DataFrame:
    """(name, outer_name, n_found) for every inner location: the one convex outer location that covers a share frac of it.
    outer_name is null unless exactly one does; locations without area are covered by none. Locations meet on tiles of their boxes, a pair once: on the first tile of both.

    A share is at most that of the boxes, and 1 where all corners lie within; only what neither settles is clipped.
    """
    def tiles(df: DataFrame, name: str, *figures) -> DataFrame:
        # exploding an array of one element keeps the figures from being computed again above the join
        one = F.struct(G.ring_bbox(F.col("ring")).alias("b"), *figures)
        df = df.select(F.col("name").alias(name), F.col("ring").alias(f"{name}_ring"), F.explode(F.array(one)).alias(f"{name}_f"))
        first = lambda v: F.floor(F.col(f"{name}_f.b.{v}0") / tile)
        span = lambda v: F.explode(F.sequence(first(v), F.floor(F.col(f"{name}_f.b.{v}1") / tile)))
        return df.withColumns({f"{name}_tx": first("x"), f"{name}_ty": first("y")}).withColumn("_bx", span("x")).withColumn("_by", span("y"))

    ring = F.col("ring")
    oriented = G.let(ring, lambda r: F.when(G.signed_area(r) < 0, F.reverse(r)).otherwise(r))
    a = tiles(inner.where(F.col("name").isNotNull()), "name", G.ring_area(ring).alias("area")).where("name_f.area > 0")
    b = tiles(outer, "outer_name", G.edges(oriented).alias("edges"))
    once = (F.col("_bx") == F.greatest("name_tx", "outer_name_tx")) & (F.col("_by") == F.greatest("name_ty", "outer_name_ty"))
    meet = lambda v: F.greatest(F.lit(0.0), F.least(F.col(f"name_f.b.{v}1"), F.col(f"outer_name_f.b.{v}1")) - F.greatest(F.col(f"name_f.b.{v}0"), F.col(f"outer_name_f.b.{v}0")))
    area = F.col("name_f.area")
    pairs = a.join(b, ["_bx", "_by"]).where(once & (meet("x") * meet("y") >= frac * area * (1 - 1e-9)))
    side = lambda e, p: (e.q.x - e.p.x) * (p.y - e.p.y) - (e.q.y - e.p.y) * (p.x - e.p.x)
    within = F.forall("name_ring", lambda p: F.forall("outer_name_f.edges", lambda e: side(e, p) >= 0))
    share = F.when(within, 1.0).otherwise(G.ring_area(G.clip_to_convex(F.col("name_ring"), F.col("outer_name_ring"))) / area)
    found = pairs.where(share >= frac).select("name", "outer_name").unionByName(inner.select("name", F.lit(None).cast(outer.schema["name"].dataType).alias("outer_name")))
    found = found.groupBy("name").agg(F.count_distinct("outer_name").alias("n_found"), F.min("outer_name").alias("o"))
    return found.select("name", F.when(F.col("n_found") == 1, F.col("o")).alias("outer_name"), "n_found")


def assemble_metrics(families: list[DataFrame], metrics: list[str]) -> DataFrame:
    """One row a sample of the first family, one column a metric. Families are (sample, metric, value); one shuffle, whatever their number."""
    base = families[0].select("sample").distinct()
    long = reduce(DataFrame.unionByName, families)
    return long.groupBy("sample").pivot("metric", metrics).agg(F.first("value", ignorenulls=True)).join(base, "sample", "left_semi")


def join_region_match(cores: DataFrame, match: DataFrame) -> DataFrame:
    """Cores (sample, region) with their matched region; where both sides have one region, that pair is fixed."""
    n = cores.groupBy("sample").agg(F.countDistinct("region").alias("_n"))
    m = match.groupBy("sample").agg(F.countDistinct("other").alias("_m"), F.min("other").alias("_only"))
    out = cores.join(match, ["sample", "region"], "left").join(n, "sample").join(m, "sample", "left")
    return out.withColumn("other", F.when((F.col("_n") == 1) & (F.col("_m") == 1), F.col("_only")).otherwise(F.col("other"))).drop("_n", "_m", "_only")


def join_confidence(long: DataFrame, lookup: DataFrame) -> DataFrame:
    """Long metrics with the value of the metric that the lookup (metric, confidence_metric; a small fixed table) names as their confidence."""
    named = long.join(F.broadcast(lookup), "metric", "left")
    conf = long.select("sample", F.col("metric").alias("confidence_metric"), F.col("value").alias("confidence"))
    return named.join(conf, ["sample", "confidence_metric"], "left")


def join_reports(df: DataFrame, files: DataFrame) -> DataFrame:
    return df.join(files, "sample", "right")


def unbroadcast(df: DataFrame) -> DataFrame:
    """df for a join that shuffles it whatever the estimates say: they follow the size of compressed files and know nothing of rows that
    were multiplied on the way, so the driver could be asked to hold millions of rows."""
    return df.hint("merge")


def _within(x: Column, y: Column, r: float) -> Column:
    """hypot(x, y) <= r; squares, which are cheap, settle nearly all pairs."""
    square = x * x + y * y
    return (square <= r * r * (1 + 1e-9) + 1e-300) & ((square <= r * r * (1 - 1e-9) - 1e-300) | (F.hypot(x, y) <= r))


def radius_join(a: DataFrame, b: DataFrame, r: float, keys: list[str] = (), carry: list[str] = (), other_carry: list[str] = ()) -> DataFrame:
    """(keys, id, other, d) of points (keys, id, x, y) of a and b at distance r at most. The smaller side belongs on the right.

    Columns of a to carry and of b (other_carry) come along, so that pairs need not be joined with their points again."""
    keys = list(keys)
    left = _bucket(a.select(*keys, "id", "x", "y", *carry), F.col("x"), F.col("y"), r)
    right = _around(b.select(*keys, F.col("id").alias("other"), F.col("x").alias("_x"), F.col("y").alias("_y"), *other_carry), F.col("_x"), F.col("_y"), r)
    dx, dy = F.col("x") - F.col("_x"), F.col("y") - F.col("_y")
    return left.join(unbroadcast(right), [*keys, "_bx", "_by"]).where(_within(dx, dy, r)).select(*keys, "id", "other", F.hypot(dx, dy).alias("d"), *carry, *other_carry)


def radius_self_join(points: DataFrame, r: float, keys: list[str] = (), carry: list[str] = ()) -> DataFrame:
    """(keys, id, other, d): all pairs id < other within r. Columns to carry come along, those of the other point as other_<name>, so that pairs need not be joined again.

    A pair of points in different cells meets once, since a point goes to its own cell and to those of four of the eight around it, no two of them opposite, that are
    within r of it: cells are two r wide, so that goes for 2.5 cells on average.
    """
    keys, names, side = list(keys), ["id", *carry], 2 * r
    left = _bucket(points.select(*keys, F.struct(*names).alias("_p"), "x", "y"), F.col("x"), F.col("y"), side)
    cell = lambda v, by: F.floor((F.col(v) + by * (r * (1 + 1e-9) + F.abs(v) * 1e-14)) / side)  # noqa: E731  with more room than rounding takes
    reached = lambda v, d: F.lit(True) if not d else cell(v, d) != F.floor(F.col(v) / side)
    half = F.explode(F.array(*[F.when(reached("x", i) & reached("y", j), F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"))) for i, j in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))]))
    right = points.select(*keys, F.struct(*names).alias("_q"), F.col("x").alias("_x"), F.col("y").alias("_y"), half.alias("_o")).where("_o is not null")
    right = right.select(*keys, "_q", "_x", "_y", (F.floor(F.col("_x") / side) + F.col("_o.i")).alias("_bx"), (F.floor(F.col("_y") / side) + F.col("_o.j")).alias("_by"), ((F.col("_o.i") == 0) & (F.col("_o.j") == 0)).alias("_own"))
    dx, dy = F.col("x") - F.col("_x"), F.col("y") - F.col("_y")
    once = (F.col("_p.id") < F.col("_q.id")) | (~F.col("_own") & (F.col("_p.id") > F.col("_q.id")))
    pairs = left.join(unbroadcast(right), [*keys, "_bx", "_by"]).where(once & _within(dx, dy, r))
    low = F.col("_p.id") < F.col("_q.id")
    first, second = F.when(low, F.col("_p")).otherwise(F.col("_q")), F.when(low, F.col("_q")).otherwise(F.col("_p"))
    return pairs.select(*keys, first.getField("id").alias("id"), second.getField("id").alias("other"), F.hypot(dx, dy).alias("d"), *[f.getField(c).alias(n + c) for n, f in (("", first), ("other_", second)) for c in carry])


def _nearest_of_batch(batches, k: int):
    """Pairs without those that have k nearer ones of the same point (_n) in their batch; pairs as near as the k-th stay. _n goes."""
    for batch in batches:
        n, d = batch.column("_n").to_numpy(), batch.column("d").to_numpy()
        order = np.lexsort((d, n))
        n, d = n[order], d[order]
        first = np.flatnonzero(np.r_[True, n[1:] != n[:-1]][: len(n)])
        size = np.diff(np.r_[first, len(n)])
        keep = np.empty(len(n), bool)
        keep[order] = d <= np.repeat(d[first + np.minimum(size, k) - 1], size)
        yield batch.select([c for c in batch.schema.names if c != "_n"]).filter(pa.array(keep))


def knn_join(a: DataFrame, b: DataFrame, k: int, keys: list[str] = (), max_dist: float | None = None, start: float = 1.0) -> DataFrame:
    """(keys, id, other, d, rank): the k nearest points of b for each of a, ties by the smaller id.

    With max_dist one radius join decides. It gives a point's pairs one after another, so far ones go batch by batch, and what is sorted does not grow with the number of points within max_dist. Without, a pyramid of cell counts bounds each point's radius before the points meet (operators.neighbours);
    `start` is the side of its finest cells. Groups with fewer than k points of b take them all. Points with a null, NaN or infinite coordinate
    have no neighbours and are none; ids are unique within a group.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys, "id").orderBy("d", "other")
    if max_dist is None:
        found = nearest(a, b, k, keys, start)
    else:
        pairs = radius_join(placed(a).withColumn("_n", F.monotonically_increasing_id()), placed(b), max_dist, keys, ["_n"])
        found = pairs.mapInArrow(partial(_nearest_of_batch, k=k), pairs.drop("_n").schema)
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mutual_nn(a: DataFrame, b: DataFrame, max_dist: float, keys: list[str] = ()) -> DataFrame:
    """Pairs that are each other's nearest neighbour."""
    keys = list(keys)
    ab = knn_join(a, b, 1, keys, max_dist).drop("rank")
    ba = knn_join(b, a, 1, keys, max_dist).select(*keys, F.col("id").alias("other"), F.col("other").alias("id"))
    return ab.join(ba, [*keys, "id", "other"])


def align_peaks(spectra: DataFrame, peaklist: DataFrame, tol: float = 0.02) -> DataFrame:
    """Observed m/z with the nearest reference m/z (`ref`) within tol, the smaller on ties; the rest is dropped.

    A fixed list of reference masses (two or three per bucket) meets the spectra on buckets of width tol, so the join is an equi-join.
    """
    refs = peaklist.select(F.col("mz").alias("ref")).distinct()
    refs = refs.withColumn("_b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col("ref") / tol) + d)))
    per_bucket = refs.groupBy("_b").agg(F.collect_set("ref").alias("_refs"))
    near = lambda mz: F.filter(F.col("_refs"), lambda r: F.abs(r - mz) <= tol + 1e-9)
    picked = F.get(F.array_sort(F.transform(near(F.col("mz")), lambda r: F.struct(F.round(F.abs(r - F.col("mz")), 9).alias("d"), r.alias("r")))), F.lit(0)).r
    out = spectra.withColumn("_b", F.floor(F.col("mz") / tol)).join(per_bucket, "_b").withColumn("ref", picked)
    return out.where("ref is not null").drop("_b", "_refs")


def nearest_mz(peaklist: DataFrame, mz: float) -> DataFrame:
    return peaklist.agg(F.min_by("mz", F.struct(F.abs(F.col("mz") - mz), F.col("mz"))).alias("mz"))


def lattice_neighbours(px: DataFrame, max_dist: float = 1.0, style: str = "B", weights: str = "binary", keys: list[str] = ("sample_id",)) -> DataFrame:
    """(keys, ims_idx, neighbour, w) on an integer grid (ims_x, ims_y): rook for max_dist < sqrt(2), else queen.

    weights: binary or inverse distance; style W divides by the row's sum. Pixels without neighbours have no row here.
    """
    keys = list(keys)
    reach = int(max_dist)
    steps = [(i, j) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1) if 0 < (i * i + j * j) ** 0.5 <= max_dist + 1e-9]
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(1.0 if weights == "binary" else (i * i + j * j) ** -0.5).alias("w")) for i, j in steps])
    moved = px.select(*keys, "ims_idx", "ims_x", "ims_y", F.explode(offsets).alias("o")).select(*keys, "ims_idx", (F.col("ims_x") + F.col("o.i")).alias("ims_x"), (F.col("ims_y") + F.col("o.j")).alias("ims_y"), "o.w")
    out = moved.join(px.select(*keys, F.col("ims_idx").alias("neighbour"), "ims_x", "ims_y"), [*keys, "ims_x", "ims_y"]).drop("ims_x", "ims_y")
    if style == "W":
        out = out.withColumn("w", F.col("w") / F.sum("w").over(Window.partitionBy(*keys, "ims_idx")))
    return out


def region_candidates(r1: DataFrame, r2: DataFrame, dmax: float, k: int = 50, ratio: float = 1.5) -> DataFrame:
    """Pairs of regions (id, x, y, area) that are among each other's k nearest within dmax and of like area."""
    ab = knn_join(r1, r2, k, max_dist=dmax).drop("rank")
    ba = knn_join(r2, r1, k, max_dist=dmax).select(F.col("id").alias("other"), F.col("other").alias("id"))
    both = ab.join(ba, ["id", "other"]).join(unbroadcast(r1.select("id", F.col("area").alias("_a"))), "id").join(unbroadcast(r2.select(F.col("id").alias("other"), F.col("area").alias("_b"))), "other")
    return both.where((F.greatest("_a", "_b") / F.least("_a", "_b")) < ratio).select("id", "other", "d")


def descriptor_candidates(k1: DataFrame, k2: DataFrame, dmax: float, a: str | None = None, b: str | None = None) -> DataFrame:
    """(id, other, d) of key points (id, x, y) within dmax, with the descriptors in column a of k1 and b of k2 where they are named."""
    return radius_join(k1, k2, dmax, carry=[a] if a else [], other_carry=[b] if b else [])


def complete(df: DataFrame, a: str, b: str, fill: dict) -> DataFrame:
    """Every combination of the values of two key columns with few values (sample, region type); absent ones filled."""
    grid = df.select(a).distinct().crossJoin(df.select(b).distinct())  # the result itself, not an intermediate
    return grid.join(df, [a, b], "left").fillna(fill)


def param_grid(spark: SparkSession, **ranges: list) -> DataFrame:
    """Product table of parameter lists."""
    out = spark.range(1).select()
    for name, values in ranges.items():
        out = out.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return out
