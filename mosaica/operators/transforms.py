"""Affine transforms: composition, application, estimation from matched points, candidate search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mosaica.functions import geometry as G
from mosaica.operators.joins import knn_join, radius_join
from mosaica.operators.lineage import cut
from mosaica.operators.neighbours import placed

FEW = 64.0  # points of a group that a trial draws its three from, on average
MATRIX = ["a", "b", "c", "d", "tx", "ty"]  # x' = a x + b y + tx, y' = c x + d y + ty


def matrix(values: dict[str, Column]) -> Column:
    return F.struct(*[values[k].cast("double").alias(k) for k in MATRIX])


def identity() -> Column:
    return matrix({k: F.lit(1.0 if k in "ad" and len(k) == 1 else 0.0) for k in MATRIX})


def multiply(second: Column, first: Column) -> Column:
    """The matrix that applies `first`, then `second`."""
    s, f = second, first
    return matrix({
        "a": s.a * f.a + s.b * f.c, "b": s.a * f.b + s.b * f.d, "c": s.c * f.a + s.d * f.c, "d": s.c * f.b + s.d * f.d,
        "tx": s.a * f.tx + s.b * f.ty + s.tx, "ty": s.c * f.tx + s.d * f.ty + s.ty,
    })


def invert(m: Column) -> Column:
    det = m.a * m.d - m.b * m.c
    return matrix({
        "a": m.d / det, "b": -m.b / det, "c": -m.c / det, "d": m.a / det,
        "tx": (m.b * m.ty - m.d * m.tx) / det, "ty": (m.c * m.tx - m.a * m.ty) / det,
    })


def compose_affine(transforms: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, m): one matrix for an ordered list of steps (keys, seq, kind, a, b, c, d, tx, ty, cx, cy).

    An affine step turns about its centre: x' = A (x - c) + c + t; a step of kind translation only moves. Null centres are 0.
    """
    zero = lambda n: F.coalesce(F.col(n), F.lit(0.0))
    move = F.col("kind") == "translation"
    part = {k: F.when(move, 1.0 if k in ("a", "d") else 0.0).otherwise(F.col(k)) for k in ("a", "b", "c", "d")}
    tx = zero("tx") + F.when(move, 0.0).otherwise(zero("cx") - part["a"] * zero("cx") - part["b"] * zero("cy"))
    ty = zero("ty") + F.when(move, 0.0).otherwise(zero("cy") - part["c"] * zero("cx") - part["d"] * zero("cy"))
    step = F.struct(F.col("seq").alias("seq"), matrix({**part, "tx": tx, "ty": ty}).alias("m"))
    chain = transforms.groupBy(*keys).agg(F.array_sort(F.collect_list(step)).alias("s"))
    return chain.select(*keys, F.aggregate("s", identity(), lambda acc, s: multiply(s.m, acc)).alias("m"))


def chain_slice(transforms: DataFrame, source: str, target: str, layers: list[str]) -> DataFrame:
    """Steps from a layer to a later one; step number seq leads from layers[seq] to layers[seq + 1]."""
    return transforms.where((F.col("seq") >= layers.index(source)) & (F.col("seq") < layers.index(target)))


def is_linear(transforms: DataFrame, keys: list[str], any_linear: bool = False) -> DataFrame:
    straight = F.col("kind") != "BSpline"
    return transforms.groupBy(*keys).agg((F.bool_or(straight) if any_linear else F.bool_and(straight)).alias("linear"))


def transform_points(points: DataFrame, transforms: DataFrame, keys: list[str], inverse: bool = False) -> DataFrame:
    """x, y moved by the matrix m of the row's keys."""
    m = invert(F.col("m")) if inverse else F.col("m")
    moved = points.join(transforms.select(*keys, m.alias("_m")), keys)
    return moved.withColumn("_x", F.col("_m.a") * F.col("x") + F.col("_m.b") * F.col("y") + F.col("_m.tx")).withColumn("y", F.col("_m.c") * F.col("x") + F.col("_m.d") * F.col("y") + F.col("_m.ty")).withColumn("x", F.col("_x")).drop("_x", "_m")


def transform_rings(rings: DataFrame, transforms: DataFrame, keys: list[str], inverse: bool = False) -> DataFrame:
    m = invert(F.col("m")) if inverse else F.col("m")
    return rings.join(transforms.select(*keys, m.alias("_m")), keys).withColumn("ring", G.transform_ring(F.col("ring"), F.col("_m"))).drop("_m")


def check_ring(rings: DataFrame, width: float, height: float, tol: float = 0.0) -> DataFrame:
    return rings.withColumn("in_range", G.ring_in_range(F.col("ring"), width, height, tol))


def select_location(locations: DataFrame, name: str, k: float = 1.0) -> DataFrame:
    return locations.where(F.col("name") == name).withColumn("ring", G.scale_ring(F.col("ring"), k))


def rotate_coords(df: DataFrame, angle: int) -> DataFrame:
    """x, y turned by a multiple of 90 degrees about half their greatest values, back to the origin; one row of bounds is broadcast."""
    turn = angle % 360
    if turn == 0:
        return df
    top = df.agg(F.max("x").alias("_mx"), F.max("y").alias("_my"))
    x, y, mx, my = F.col("x"), F.col("y"), F.col("_mx"), F.col("_my")
    nx, ny = {90: (my - y, x), 180: (mx - x, my - y), 270: (y, mx - x)}[turn]
    return df.crossJoin(F.broadcast(top)).withColumn("_x", nx).withColumn("y", ny).withColumn("x", F.col("_x")).drop("_x", "_mx", "_my")


def expand_core_box(boxes: DataFrame, diameter: float) -> DataFrame:
    """x0, y0, x1, y1 grown about the centre to a diameter; an edge of the mask's box (m0x, m0y, m1x, m1y) replaces it where it lies outside."""
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    h = diameter / 2
    return boxes.withColumns({
        "e0x": F.least(F.col("x0"), cx - h, F.coalesce("m0x", "x0")), "e0y": F.least(F.col("y0"), cy - h, F.coalesce("m0y", "y0")),
        "e1x": F.greatest(F.col("x1"), cx + h, F.coalesce("m1x", "x1")), "e1y": F.greatest(F.col("y1"), cy + h, F.coalesce("m1y", "y1")),
    })


# ---- estimation; pairs: keys, id, p1x, p1y, p2x, p2y ----


def fit_affine(pairs: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """(keys, n, m): least-squares affine from p1 to p2, null for groups whose points lie on a line.

    One aggregation of centred sums; the 2 x 2 systems are solved in column arithmetic.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    sums = {"w": w} | {n: w * F.col(n) for n in ("p1x", "p1y", "p2x", "p2y")}
    mean = pairs.groupBy(*keys).agg(F.count("*").alias("n"), *[(F.sum(sums[n]) / F.sum(w)).alias(f"m_{n}") for n in ("p1x", "p1y", "p2x", "p2y")])
    c = pairs.join(mean, keys) if keys else pairs.crossJoin(F.broadcast(mean))  # one row
    d = {n: F.col(n) - F.col(f"m_{n}") for n in ("p1x", "p1y", "p2x", "p2y")}
    s = {f"{a}{b}": F.sum(w * d[a] * d[b]) for a, b in (("p1x", "p1x"), ("p1x", "p1y"), ("p1y", "p1y"), ("p1x", "p2x"), ("p1y", "p2x"), ("p1x", "p2y"), ("p1y", "p2y"))}
    g = c.groupBy(*keys, "n", *[f"m_{n}" for n in d]).agg(*[v.alias(k) for k, v in s.items()])
    xx, xy, yy = F.col("p1xp1x"), F.col("p1xp1y"), F.col("p1yp1y")
    det = xx * yy - xy * xy
    solve = lambda u, v: ((u * yy - v * xy) / det, (v * xx - u * xy) / det)
    (a, b), (c_, d_) = solve(F.col("p1xp2x"), F.col("p1yp2x")), solve(F.col("p1xp2y"), F.col("p1yp2y"))
    tx = F.col("m_p2x") - a * F.col("m_p1x") - b * F.col("m_p1y")
    ty = F.col("m_p2y") - c_ * F.col("m_p1x") - d_ * F.col("m_p1y")
    return g.select(*keys, "n", F.when(det > 1e-12 * (xx + yy) * (xx + yy), matrix({"a": a, "b": b, "c": c_, "d": d_, "tx": tx, "ty": ty})).alias("m"))


def residual() -> Column:
    """Distance of p1, moved by the row's m, from p2."""
    rx = F.col("m.a") * F.col("p1x") + F.col("m.b") * F.col("p1y") + F.col("m.tx") - F.col("p2x")
    ry = F.col("m.c") * F.col("p1x") + F.col("m.d") * F.col("p1y") + F.col("m.ty") - F.col("p2y")
    return F.hypot(rx, ry)


def residuals(pairs: DataFrame, fit: DataFrame, keys: list[str]) -> DataFrame:
    """pairs with the distance of the moved p1 from p2."""
    j = pairs.join(fit.select(*keys, "m"), keys) if keys else pairs.crossJoin(F.broadcast(fit.select("m")))  # one row
    return j.withColumn("residual", residual()).drop("m")


def fit_rigid(pairs: DataFrame, keys: list[str], scale: bool = True) -> DataFrame:
    """(keys, n, angle, scale, m): rotation, scale and shift, in closed form from centred sums."""
    mean = pairs.groupBy(*keys).agg(F.count("*").alias("n"), *[F.avg(n).alias(f"m_{n}") for n in ("p1x", "p1y", "p2x", "p2y")])
    c = pairs.join(mean, keys) if keys else pairs.crossJoin(F.broadcast(mean))  # one row
    d = {n: F.col(n) - F.col(f"m_{n}") for n in ("p1x", "p1y", "p2x", "p2y")}
    g = c.groupBy(*keys, "n", *[f"m_{n}" for n in d]).agg(
        F.sum(d["p1x"] * d["p2x"] + d["p1y"] * d["p2y"]).alias("dot"), F.sum(d["p1x"] * d["p2y"] - d["p1y"] * d["p2x"]).alias("cross"),
        F.sum(d["p1x"] * d["p1x"] + d["p1y"] * d["p1y"]).alias("norm"),
    )
    turn = F.atan2("cross", "dot")
    k = F.hypot("cross", "dot") / F.col("norm") if scale else F.lit(1.0)
    cos, sin = k * F.cos(turn), k * F.sin(turn)
    m = matrix({"a": cos, "b": -sin, "c": sin, "d": cos, "tx": F.col("m_p2x") - cos * F.col("m_p1x") + sin * F.col("m_p1y"), "ty": F.col("m_p2y") - sin * F.col("m_p1x") - cos * F.col("m_p1y")})
    return g.select(*keys, "n", F.degrees(turn).alias("angle"), k.alias("scale"), m.alias("m"))


def fit_affine_robust(pairs: DataFrame, keys: list[str], threshold: float, trials: int = 64, seed: int = 0, least: int = 5) -> DataFrame:
    """(keys, n, n_inliers, m): the best of `trials` three-point affines by inliers, fitted again to them; null m and 0 inliers below `least`.

    Trials draw their points by hash, those of the three least, so results repeat. A group's size tells below which hash a trial has some FEW of its points, and only
    those are ranked; trials that find fewer than three so (repeated ids share a hash) rank all points of their group. A group's hypotheses are one row, so that points
    meet them by the group's key, and inliers are counted in every task before the shuffle.
    """
    n = cut(pairs.groupBy(*keys).agg(F.count("*").alias("n")))
    by_group = lambda df, one: df.join(one, keys) if keys else df.crossJoin(F.broadcast(one))  # noqa: E731  one row
    every = F.explode(F.sequence(F.lit(1), F.lit(trials))).alias("trial")
    h = F.xxhash64("id", "trial", F.lit(seed))
    w = Window.partitionBy(*keys, "trial").orderBy("_h", "id")
    picks = by_group(pairs, n).select(*keys, "id", "p1x", "p1y", "p2x", "p2y", "n", every).withColumn("_h", h)
    first = lambda df: df.withColumn("_n", F.row_number().over(w)).where("_n <= 3").drop("_n", "_h", "n")
    low = (F.col("_h").cast("double") / float(1 << 64) + 0.5) * F.col("n") <= FEW
    sample = cut(first(picks.where(low)))
    drawn = sample.groupBy(*keys, "trial").agg(F.count("*").alias("_k"))
    short = n.select(*keys, "n", every).join(drawn, [*keys, "trial"], "left").where(F.coalesce("_k", F.lit(0)) < F.least("n", F.lit(3))).select(*keys, "trial")
    if not short.isEmpty():
        sample = sample.join(short, [*keys, "trial"], "left_anti").unionByName(first(picks.join(short, [*keys, "trial"], "left_semi")))
    hypotheses = fit_affine(sample, [*keys, "trial"]).where("m is not null").groupBy(*keys).agg(F.collect_list(F.struct("trial", "m")).alias("_all"))
    hypotheses = cut(hypotheses)
    tried = by_group(pairs, hypotheses).select(*keys, "p1x", "p1y", "p2x", "p2y", F.explode("_all").alias("_t")).select(*keys, "p1x", "p1y", "p2x", "p2y", "_t.trial", "_t.m")
    counts = tried.groupBy(*keys, "trial").agg(F.sum((residual() <= threshold).cast("int")).alias("n_inliers"))
    top = counts.groupBy(*keys).agg(F.max_by("trial", F.struct("n_inliers", -F.col("trial"))).alias("trial"), F.max("n_inliers").alias("n_inliers"))
    top = cut(top)
    best = by_group(hypotheses, top).select(*keys, F.explode("_all").alias("_t"), "trial").where("_t.trial = trial").select(*keys, "_t.m")
    fit = fit_affine(residuals(pairs, best, keys).where(F.col("residual") <= threshold), keys).select(*keys, "m")
    out = (n.join(top.drop("trial"), keys, "left").join(fit, keys, "left")) if keys else n.crossJoin(top.drop("trial")).crossJoin(fit)
    enough = F.coalesce(F.col("n_inliers"), F.lit(0)) >= least
    return out.select(*keys, "n", F.when(enough, F.col("n_inliers")).otherwise(0).alias("n_inliers"), F.when(enough, F.col("m")).alias("m"))


def score_inliers(pairs: DataFrame, fit: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    return residuals(pairs, fit, keys).withColumn("inlier", F.col("residual") <= threshold)


def affine_metrics(fit: DataFrame, keys: list[str]) -> DataFrame:
    return fit.select(*keys, F.col("m.tx").alias("global_x_shift"), F.col("m.ty").alias("global_y_shift"), *[F.col(f"m.{k}").alias(f"affine_{k}") for k in ("a", "b", "c", "d")])


def landmark_error(meta: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, error): the least mean distance of landmarks (p1, p2) under eight readings of the stored matrix m: as it is or transposed,
    forward or inverse, and each in both directions."""
    t = matrix({"a": F.col("m.a"), "b": F.col("m.c"), "c": F.col("m.b"), "d": F.col("m.d"), "tx": F.col("m.tx"), "ty": F.col("m.ty")})
    readings = [F.col("m"), invert(F.col("m")), t, invert(t)]
    tried = meta.withColumn("_v", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), r.alias("m"), F.lit(back).alias("back")) for i, r in enumerate(readings) for back in (False, True)])))
    back = F.col("_v.back")
    ax, ay = F.when(back, F.col("p2x")).otherwise(F.col("p1x")), F.when(back, F.col("p2y")).otherwise(F.col("p1y"))
    bx, by = F.when(back, F.col("p1x")).otherwise(F.col("p2x")), F.when(back, F.col("p1y")).otherwise(F.col("p2y"))
    m = F.col("_v.m")
    d = F.hypot(m.a * ax + m.b * ay + m.tx - bx, m.c * ax + m.d * ay + m.ty - by)
    return tried.groupBy(*keys, "_v.i", "_v.back").agg(F.avg(d).alias("e")).groupBy(*keys).agg(F.min("e").alias("error"))


def score_shifts(a: DataFrame, b: DataFrame, grid: DataFrame, max_dist: float) -> DataFrame:
    """(dx, dy, worst): for each candidate shift of a the greatest nearest-neighbour distance to b; null where a point finds none within max_dist.

    The candidate is part of the key, so candidates spread over tasks.
    """
    g = grid.withColumn("cand", F.row_number().over(Window.orderBy("dx", "dy")))  # a parameter grid
    moved = a.crossJoin(F.broadcast(g)).select("cand", F.col("id"), (F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y"))
    spread = b.crossJoin(F.broadcast(g.select("cand"))).select("cand", "id", "x", "y")
    near = knn_join(moved, spread, 1, ["cand"], max_dist)
    n = moved.groupBy("cand").agg(F.count("*").alias("n"))
    worst = near.groupBy("cand").agg(F.max("d").alias("w"), F.count("*").alias("found"))
    return g.join(n, "cand").join(worst, "cand", "left").select("dx", "dy", F.when(F.col("found") == F.col("n"), F.col("w")).alias("worst"))


def accept_rigid(fit: DataFrame) -> DataFrame:
    """Fits with scale in .9 to 1.1 and a rotation part within .1 of the identity."""
    m = F.col("m")
    return fit.where(F.col("scale").between(0.9, 1.1) & (F.greatest(F.abs(m.a - 1), F.abs(m.b), F.abs(m.c), F.abs(m.d - 1)) < 0.1))


def _turned(x: Column, y: Column) -> tuple[Column, Column]:
    """Where a candidate (dx, dy, rotation in degrees) puts x, y."""
    turn = F.radians("rotation")
    return x * F.cos(turn) - y * F.sin(turn) + F.col("dx"), x * F.sin(turn) + y * F.cos(turn) + F.col("dy")


def outline_coverage(pixels: DataFrame, grid: DataFrame, outline: DataFrame, least: float, tile: float = 16.0) -> DataFrame:
    """(candidate, coverage): share of the moved pixels (x, y) inside a convex outline (ring, counter-clockwise; one row), of candidates that reach `least`.

    Pixels are counted by tiles, and the corners of a tile's box bound its share: with all four inside the whole tile is, and a tile whose moved box does not
    touch the outline's is outside. Candidates whose bound stays below `least` go before any pixel is moved; for the others only pixels of tiles that the outline may cut
    are. The result is that of moving every pixel. Pixels without a place do not count; without any pixel there is no candidate.
    """
    at = placed(pixels.select("x", "y")).withColumns({"_tx": F.floor(F.col("x") / tile), "_ty": F.floor(F.col("y") / tile)})
    slack = 1e-6  # corners lie a little outside, so that rounding cannot make a cut tile a whole one
    tiles = at.groupBy("_tx", "_ty").agg(F.count("*").alias("n"), *[(g(c) + e).alias(f"_{c}{i}") for c in ("x", "y") for g, e, i in ((F.min, -slack, 0), (F.max, slack, 1))])
    total = at.agg(F.count("*").alias("_total"))
    ring = outline.select("ring")
    corners = [_turned(F.col(f"_x{i}"), F.col(f"_y{j}")) for i in (0, 1) for j in (0, 1)]
    moved = tiles.crossJoin(F.broadcast(grid.select("candidate", "dx", "dy", "rotation"))).crossJoin(F.broadcast(ring))  # a parameter grid, one row
    within = reduce(lambda p, q: p & q, [G.in_convex(x, y, F.col("ring")) for x, y in corners])
    xs, ys = [x for x, _ in corners], [y for _, y in corners]
    span = lambda c: (F.array_min(F.transform("ring", lambda p: p[c])), F.array_max(F.transform("ring", lambda p: p[c])))
    touch = reduce(lambda p, q: p & q, [(F.least(*v) <= span(c)[1]) & (F.greatest(*v) >= span(c)[0]) for v, c in ((xs, "x"), (ys, "y"))])
    judged = moved.select("candidate", "dx", "dy", "rotation", "_tx", "_ty", "n", within.alias("_in"), touch.alias("_touch"))
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    bound = judged.groupBy("candidate").agg(count(F.col("_in")).alias("_sure"), count(F.col("_in") | F.col("_touch")).alias("_most")).crossJoin(F.broadcast(total)).where(F.col("_most") >= least * F.col("_total"))
    bound = cut(bound)
    mixed = judged.where(~F.col("_in") & F.col("_touch")).join(bound.select("candidate"), "candidate", "left_semi").drop("n", "_in", "_touch").join(at, ["_tx", "_ty"])
    x, y = _turned(F.col("x"), F.col("y"))
    single = mixed.crossJoin(F.broadcast(ring)).groupBy("candidate").agg(F.sum(G.in_convex(x, y, F.col("ring")).cast("long")).alias("_single"))
    share = (F.col("_sure") + F.coalesce("_single", F.lit(0))) / F.col("_total")
    return bound.join(single, "candidate", "left").select("candidate", share.alias("coverage")).where(F.col("coverage") >= least)


def grid_search(points: DataFrame, pixels: DataFrame, grid: DataFrame, outline: DataFrame | None = None, least_coverage: float = 0.95) -> DataFrame:
    """For each candidate (candidate, dx, dy, rotation in degrees) of moving the pixels (id, x, y): share inside a convex outline, matches of points (id, x, y,
    weight) to pixels within 1, mean weight, mean and weighted mean distance. Each pixel looks for its nearest point (ties by the smaller id), each point keeps its closest
    such pixel. Candidates that cover too little go (outline_coverage), and so do those without a match. Points and pixels without a place match nothing.

    A candidate moves points back instead of pixels on, which leaves distances as they are: the few points are copied for every candidate, the pixels are not.
    """
    if outline is None:
        cover = grid.select("candidate", F.lit(1.0).alias("coverage"))
    else:
        cover = cut(outline_coverage(pixels, grid, outline, least_coverage))
    turn, x, y = F.radians("rotation"), F.col("x") - F.col("dx"), F.col("y") - F.col("dy")
    tried = grid.join(F.broadcast(cover.select("candidate")), "candidate", "left_semi")  # at most the parameter grid
    back = placed(points).crossJoin(F.broadcast(tried)).select(F.struct("candidate", F.col("id").alias("point")).alias("id"), (x * F.cos(turn) + y * F.sin(turn)).alias("x"), (y * F.cos(turn) - x * F.sin(turn)).alias("y"))
    near = radius_join(back, placed(pixels), 1.0).select("id.candidate", "id.point", F.col("other").alias("pixel"), "d")
    own = near.groupBy("candidate", "pixel").agg(F.min(F.struct("d", "point")).alias("_n")).select("candidate", F.col("_n.point").alias("id"), F.col("_n.d").alias("d"))
    per_point = own.groupBy("candidate", "id").agg(F.min("d").alias("d")).join(points.select("id", "weight"), "id")
    scored = per_point.groupBy("candidate").agg(F.avg("weight").alias("mean_weight"), F.count("*").alias("n_matches"), F.avg("d").alias("mean_distance"), (F.sum(F.col("d") * F.col("weight")) / F.count("*")).alias("weighted_distance"))
    return cover.join(scored, "candidate")


def score_thresholds(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """2 w / max w + n / max n + 4 b / max b of candidates (w, n, b); a greatest value of 0 counts as 1."""
    g = Window.partitionBy(*keys)
    part = lambda c: F.col(c) / F.when(F.max(c).over(g) == 0, 1.0).otherwise(F.max(c).over(g))
    return candidates.withColumn("score", 2 * part("w") + part("n") + 4 * part("b"))


def icp(a: DataFrame, b: DataFrame, keys: list[str], kind: str = "affine", tol: float = 1e-3, max_dist: float = 10.0, rounds: int = 20) -> DataFrame:
    """(keys, m, status): iterated closest point from a to b, until every group's points move less than tol on average; lineage is cut each round. status is ok, or
    `not converged` for groups that still moved by tol in the last round. Groups without pairs within max_dist have no row."""
    fit_of = fit_affine if kind == "affine" else fit_rigid
    start = cut(a.select(*keys, "id", F.col("x").alias("p1x"), F.col("y").alias("p1y"), "x", "y"))
    fit = None
    for _ in range(rounds):
        near = knn_join(start.select(*keys, "id", "x", "y"), b, 1, keys, max_dist)
        target = b.select(*keys, F.col("id").alias("other"), F.col("x").alias("p2x"), F.col("y").alias("p2y"))
        pairs = near.join(start.select(*keys, "id", "p1x", "p1y"), [*keys, "id"]).join(target, [*keys, "other"])
        fit = cut(fit_of(pairs, keys).where("m is not null").select(*keys, "m"))
        moved = start.join(fit, keys).withColumn("nx", F.col("m.a") * F.col("p1x") + F.col("m.b") * F.col("p1y") + F.col("m.tx")).withColumn("ny", F.col("m.c") * F.col("p1x") + F.col("m.d") * F.col("p1y") + F.col("m.ty"))
        moved = cut(moved)
        per = cut(moved.groupBy(*keys).agg(F.avg(F.hypot(F.col("nx") - F.col("x"), F.col("ny") - F.col("y"))).alias("_moved")))
        worst = per.agg(F.max("_moved")).first()[0]
        start = moved.select(*keys, "id", "p1x", "p1y", F.col("nx").alias("x"), F.col("ny").alias("y"))
        if worst is None or worst < tol:
            break
    ended = fit.join(per, keys) if keys else fit.crossJoin(F.broadcast(per))  # one row
    return ended.select(*keys, "m", F.when(F.col("_moved") < tol, "ok").otherwise("not converged").alias("status"))
