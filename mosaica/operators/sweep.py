"""Marks in a raster at many thresholds at once, and the sweep that chooses among them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mosaica.operators.components import connected_components
from mosaica.operators.graphs import filter_lattice, merge_points
from mosaica.operators.lineage import cut
from mosaica.operators.transforms import score_thresholds

TILE = 64
_STATS = ["area", "s_row", "s_col", "r0", "c0", "r1", "c1"]


def merge_tree(rows: np.ndarray, cols: np.ndarray, level: np.ndarray, levels: int) -> tuple[list[tuple], list[tuple]]:
    """(components, borders) of one tile's pixels; a pixel is on at the thresholds 0 .. level - 1, its first so many of `levels`.

    Thresholds fall from the highest on: the pixels that join are united with their neighbours that are on, and only the components they touch change. components:
    (threshold, root, area, sum of rows, sum of columns, box), one for each threshold and component, root being its first pixel (row << 32 | column).
    borders: (pixel, from, to, root), the runs of thresholds over which a pixel on the tile's rim has one root."""
    n = len(rows)
    at = {(r, c): i for i, (r, c) in enumerate(zip(rows.tolist(), cols.tolist()))}
    packed = (rows.astype(np.int64) << 32 | cols.astype(np.int64)).tolist()
    parent = list(range(n))
    stats = [[1, int(r), int(c), int(r), int(c), int(r), int(c)] for r, c in zip(rows, cols)]
    on = [False] * n
    rim = [i for i in range(n) if rows[i] % TILE in (0, TILE - 1) or cols[i] % TILE in (0, TILE - 1)]
    runs: dict[int, list] = {}  # rim pixel: [highest threshold of the run, root]
    components, borders = [], []
    by_level: list[list[int]] = [[] for _ in range(levels + 1)]
    for i, v in enumerate(level.tolist()):
        by_level[v].append(i)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    roots: set[int] = set()
    for t in range(levels - 1, -1, -1):
        for i in by_level[t + 1]:
            on[i] = True
            roots.add(i)
            r, c = int(rows[i]), int(cols[i])
            for near in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)):
                j = at.get(near)
                if j is not None and on[j]:
                    a, b = find(i), find(j)
                    if a != b:
                        if packed[b] < packed[a]:
                            a, b = b, a
                        parent[b] = a
                        roots.discard(b)
                        s, o = stats[a], stats[b]
                        stats[a] = [s[0] + o[0], s[1] + o[1], s[2] + o[2], min(s[3], o[3]), min(s[4], o[4]), max(s[5], o[5]), max(s[6], o[6])]
        components += [(t, packed[i], *stats[i]) for i in roots]
        for i in rim:
            if on[i]:
                root = packed[find(i)]
                run = runs.get(i)
                if run is None:
                    runs[i] = [t, root]
                elif run[1] != root:
                    borders.append((packed[i], t + 1, run[0], run[1]))
                    runs[i] = [t, root]
    borders += [(packed[i], 0, top, root) for i, (top, root) in runs.items()]
    return components, borders


def threshold_components(raster: DataFrame, thresholds: list[float], keys: list[str] = ()) -> DataFrame:
    """(keys, threshold, component, area, c_row, c_col, r0, c0, r1, c1): the 4-connected components of the pixels (keys, row, col, value) above each threshold, component
    being its first pixel as row << 32 | column. Nulls and NaN are never above; rows and columns are not negative; of repeated pixels the largest value counts.

    The raster is read once for all thresholds. A tile of TILE x TILE pixels is one group, whose merge tree gives its components at every threshold; tiles meet where
    pixels on both sides of a rim are on, and one components job over (threshold, root) unites them for all thresholds together. Sums and boxes add up."""
    keys, levels = list(keys), sorted({float(t) for t in thresholds})
    types = {f.name: f.dataType.simpleString() for f in raster.schema}
    head = "".join(f"`{k}` {types[k]}, " for k in keys)
    bounds = F.array(*[F.lit(t) for t in levels])
    level = F.size(F.filter(bounds, lambda t: F.col("value") > t))
    on = raster.where("value is not null").where(~F.isnan(F.col("value").cast("double"))).groupBy(*keys, "row", "col").agg(F.max(F.col("value").cast("double")).alias("value"))
    px = on.withColumn("level", level).where("level > 0").withColumn("_tr", F.floor(F.col("row") / TILE)).withColumn("_tc", F.floor(F.col("col") / TILE))

    def grown(pdf: pd.DataFrame) -> pd.DataFrame:
        parts, rims = merge_tree(pdf["row"].to_numpy(), pdf["col"].to_numpy(), pdf["level"].to_numpy(), len(levels))
        out = pd.DataFrame([(None, t, None, *rest) for t, *rest in parts] + [(pixel, low, high, root, *[None] * 7) for pixel, low, high, root in rims], columns=["pixel", "low", "high", "root", *_STATS])
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[[*keys, "pixel", "low", "high", "root", *_STATS]].astype({c: "Int64" for c in ["pixel", "low", "high", "root", *_STATS]})

    made = cut(px.groupBy(*keys, "_tr", "_tc").applyInPandas(grown, head + "pixel long, low int, high int, root long, " + ", ".join(f"{c} long" for c in _STATS)))
    parts, rims = made.where("pixel is null").select(*keys, F.col("low").alias("level"), "root", *_STATS), made.where("pixel is not null")
    # Pixels on both sides of a rim: each looks right and down, into the next tile only.
    row, col = F.shiftright("pixel", 32), F.col("pixel").bitwiseAND(F.lit((1 << 32) - 1))
    right = rims.where(col % TILE == TILE - 1).select(*keys, (F.col("pixel") + 1).alias("next"), "low", "high", "root")
    down = rims.where(row % TILE == TILE - 1).select(*keys, (F.col("pixel") + (1 << 32)).alias("next"), "low", "high", "root")
    other = rims.select(*keys, F.col("pixel").alias("next"), F.col("low").alias("_low"), F.col("high").alias("_high"), F.col("root").alias("_root"))
    met = right.unionByName(down).join(other, [*keys, "next"]).select(*keys, "root", "_root", F.greatest("low", "_low").alias("low"), F.least("high", "_high").alias("high")).where("low <= high").distinct()
    node = lambda root: F.struct(*keys, "level", F.col(root).alias("root"))
    edges = met.withColumn("level", F.explode(F.sequence("low", "high"))).select(node("root").alias("a"), node("_root").alias("b")).distinct()
    roots = connected_components(edges, "a", "b").select(F.col("node").alias("_node"), F.col("root.root").alias("_first"))
    whole = parts.withColumn("_node", node("root")).join(roots, "_node", "left").withColumn("component", F.coalesce("_first", "root"))
    out = whole.groupBy(*keys, "level", "component").agg(F.sum("area").alias("area"), F.sum("s_row").alias("s_row"), F.sum("s_col").alias("s_col"), F.min("r0").alias("r0"), F.min("c0").alias("c0"), F.max("r1").alias("r1"), F.max("c1").alias("c1"))
    return out.select(*keys, F.get(bounds, F.col("level")).alias("threshold"), "component", "area", (F.col("s_row") / F.col("area")).alias("c_row"), (F.col("s_col") / F.col("area")).alias("c_col"), "r0", "c0", "r1", "c1")


def threshold_marks(raster: DataFrame, thresholds: list[float], pixel: float, resolution: float, step: float, keys: list[str] = (), least: int = 6, min_n: int = 9) -> DataFrame:
    """(keys, threshold, id, x, y): the marks at each threshold, in steps (x along columns): components of plausible area and shape that lie on a lattice.

    The area is above that of the smallest circle of ablation and below a pixel's; width and height within a factor of two. A threshold with fewer than `least` components after
    either test has no marks. Marks stay if they belong to a lattice component of more than min_n marks."""
    keys, g = list(keys), [*keys, "threshold"]
    radius = (pixel / 8 + (pixel / 8 - 1) * 2.5) / resolution
    smallest = np.pi * (radius * radius if radius > 0 else 1.0)
    p = threshold_components(raster, thresholds, keys).where((F.col("area") > float(smallest)) & (F.col("area") < (pixel / resolution) ** 2))
    h, w = F.col("r1") - F.col("r0") + 1, F.col("c1") - F.col("c0") + 1
    n = cut(p).groupBy(*g).agg(F.count("*").alias("_n"), F.count_if(F.greatest(h / w, w / h) < 2).alias("_round")).where((F.col("_n") >= least) & (F.col("_round") >= least)).select(*g)
    good = p.join(n, g, "left_semi").where(F.greatest(h / w, w / h) < 2)
    points = good.select(*g, F.struct(*g, "component").alias("id"), (F.col("c_col") * resolution / step).alias("x"), (F.col("c_row") * resolution / step).alias("y"))
    return filter_lattice(cut(points), min_n, g).select(*g, "id", "x", "y")


def sweep_thresholds(raster: DataFrame, distance: DataFrame, pixel: float, resolution: float, step: float, low: int = 127, high: int = 250, keys: list[str] = (), least: int = 6, min_n: int = 9, near_best: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """(chosen, marks). chosen: (keys, threshold, n, b, w), a group's best threshold and the greatest counts of the last, finest round. marks: (keys, id, x, y), the union of the
    marks of all thresholds whose score is near the best, on a lattice.

    distance: (keys, row, col, distance), signed pixels from the tissue's edge. A threshold's criteria are n marks, b marks within two steps of the edge, and w, the sum of inverse
    distances (0 at the edge itself). Thresholds are scored in steps of 10 from low to below high, then of 3 around the best, then of 1, each round by its own greatest
    values; scores equal to nine digits take the smallest threshold. All thresholds that a round may ask for come from one pass over the raster, so the rounds choose among rows
    that are there. A group without marks anywhere keeps its smallest thresholds and has no marks."""
    keys = list(keys)
    g = [*keys, "threshold"]
    marks = cut(threshold_marks(raster, list(range(low - 11, high + 12)), pixel, resolution, step, keys, least, min_n))
    at = marks.select(*g, F.floor(F.col("y") * step / resolution).cast("long").alias("row"), F.floor(F.col("x") * step / resolution).cast("long").alias("col"))
    far = at.join(distance.select(*keys, F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), (F.col("distance") / step * resolution).alias("_d")), [*keys, "row", "col"], "left")
    counts = far.groupBy(*g).agg(F.count("*").alias("n"), F.count_if(F.col("_d") <= 2).alias("b"), F.sum(F.when(F.col("_d") != 0, 1 / F.col("_d")).otherwise(0.0)).alias("w"))
    groups = raster.select(*keys).distinct() if keys else raster.sparkSession.range(1).select()
    every = groups.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in range(low - 11, high + 12)])))
    counts = cut(every.join(counts, g, "left").fillna(0, subset=["n", "b"]).fillna(0.0, subset=["w"]))

    def best(tried: DataFrame) -> DataFrame:
        top = Window.partitionBy(*keys).orderBy(F.round("score", 9).desc(), "threshold")  # sums differ by their order; some two hundred thresholds a group at most
        return score_thresholds(tried, keys).withColumn("_r", F.row_number().over(top)).where("_r = 1").select(*keys, F.col("threshold").alias("_best"))

    coarse = counts.where((F.col("threshold") >= low) & (F.col("threshold") < high) & ((F.col("threshold") - low) % 10 == 0))
    join = lambda a, b: a.join(b, keys) if keys else a.crossJoin(F.broadcast(b))  # noqa: E731  one row
    around = join(counts, best(coarse)).withColumn("_off", F.col("threshold") - F.col("_best"))
    medium = around.where((F.col("_off") >= -9) & (F.col("_off") <= 9) & (F.pmod(F.col("_off") + 9, F.lit(3.0)) == 0)).drop("_off", "_best")
    around = join(counts, best(medium)).withColumn("_off", F.col("threshold") - F.col("_best"))
    fine = around.where(F.abs("_off") <= 2).drop("_off", "_best")
    tops = fine.groupBy(*keys).agg(F.max("n").alias("n"), F.max("b").alias("b"), F.max("w").alias("w"))
    chosen = cut(join(tops, best(fine)).select(*keys, F.col("_best").alias("threshold"), "n", "b", "w"))

    scored = score_thresholds(coarse.unionByName(medium).unionByName(fine).dropDuplicates(g), keys)
    near = scored.where("n > 0").withColumn("_top", F.max("score").over(Window.partitionBy(*keys))).where(F.col("score") >= near_best * F.col("_top"))
    order = near.withColumn("_order", F.row_number().over(Window.partitionBy(*keys).orderBy(F.round("score", 9).desc(), "threshold"))).select(*g, "_order")
    kept = marks.join(order, g).select(*keys, F.struct(F.struct(*keys).alias("g"), F.col("_order").alias("order"), F.col("id.component").alias("component")).alias("id"), "x", "y") if keys else marks.join(order, g).select(F.struct(F.col("_order").alias("order"), F.col("id.component").alias("component")).alias("id"), "x", "y")
    union = merge_points(kept, kept.limit(0), keys=keys)
    return chosen, filter_lattice(union, min_n, keys).select(*keys, "id", "x", "y")
