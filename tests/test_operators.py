"""Operators that SQL cannot express, against closed forms and brute force."""

import json
import math
import re
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mosaica.functions import geometry as G
from mosaica.functions import scalars
from mosaica.operators import aggregates as A
from mosaica.operators import graphs, joins, lookups, models, rasters, sweep, transforms, verdicts, windows
from mosaica.sources import files


def ring(*pts):
    return [{"x": float(x), "y": float(y)} for x, y in [*pts, pts[0]]]


RINGS = "id int, ring array<struct<x:double,y:double>>"


def test_geometry_closed_forms(spark):
    df = spark.createDataFrame([(0, ring((0, 0), (4, 0), (4, 4), (0, 4))), (1, ring((0, 0), (6, 0), (0, 6))), (2, ring((0, 0), (4, 0), (4, 4), (3, 4), (3, 1), (1, 1), (1, 4), (0, 4))), (3, [])], RINGS)
    r = F.col("ring")
    box = [F.lit(float(v)) for v in (1, 1, 3.5, 5)]
    got = {x.id: x for x in df.select("id", G.ring_area(r).alias("a"), G.ring_centroid(r).alias("c"), G.ring_area(G.clip_to_box(r, *box)).alias("k"), G.box_overlap_area(r, *box).alias("o"), G.point_in_ring(F.lit(2.0), F.lit(2.0), r).alias("i"), G.point_in_ring(F.lit(4.0), F.lit(2.0), r).alias("e")).collect()}
    assert [got[i].a for i in range(4)] == pytest.approx([16, 18, 10, 0])
    assert (got[1].c.x, got[1].c.y) == pytest.approx((2, 2)) and got[3].c is None
    for i in range(3):
        assert got[i].k == pytest.approx(got[i].o)
    assert got[0].o == pytest.approx(7.5) and got[2].o == pytest.approx(1.5)
    assert [got[i].i for i in range(4)] == [True, True, False, False] and not got[0].e


def test_components_and_polygons(spark):
    rng = random.Random(3)
    px = [(r, c) for r in range(25) for c in range(25) if rng.random() < 0.55]
    df = spark.createDataFrame(px, "row int, col int")
    for diagonal, steps in ((False, [(0, 1), (1, 0), (0, -1), (-1, 0)]), (True, [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)])):
        left, parts = set(px), []
        while left:
            todo, part = [left.pop()], set()
            while todo:
                p = todo.pop()
                part.add(p)
                for i, j in steps:
                    q = (p[0] + i, p[1] + j)
                    if q in left:
                        left.remove(q)
                        todo.append(q)
            parts.append(frozenset(part))
        got = {}
        for r in graphs.pixel_components(df, diagonal).collect():
            got.setdefault(r.component, set()).add((r.row, r.col))
        assert set(map(frozenset, got.values())) == set(parts)
    labelled = [(0, r, c, 1) for r in range(4) for c in range(5)] + [(0, r, c + 9, 2) for r in range(3) for c in range(3) if (r, c) != (1, 1)] + [(0, 9, 0, 3), (0, 9, 2, 3), (0, 12, 0, 4), (0, 12, 1, 4), (0, 13, 1, 4)]
    polys = {r.label: r.ring for r in rasters.labels_to_polygons(spark.createDataFrame(labelled, "image_id int, row int, col int, label int")).collect()}
    assert set(polys) == {1, 4}  # a hole and two parts are dropped
    assert len(polys[1]) == 5 and len(polys[4]) == 7


def test_hull(spark):
    rng = np.random.default_rng(1)
    pts = rng.integers(0, 30, (200, 2)).astype(float)
    df = spark.createDataFrame([("a", float(x), float(y)) for x, y in pts], "g string, x double, y double")
    hull = A.convex_hull(df, "g").first().ring
    for p, q in zip(hull, hull[1:]):
        assert ((q.x - p.x) * (pts[:, 1] - p.y) - (q.y - p.y) * (pts[:, 0] - p.x) >= 0).all()


def test_transforms(spark):
    rng = np.random.default_rng(2)
    p = rng.normal(0, 20, (60, 2))
    a, t = np.array([[1.1, 0.2], [-0.1, 0.9]]), np.array([3.0, -7.0])
    q = p @ a.T + t
    q[:15] += rng.normal(0, 80, (15, 2))
    df = spark.createDataFrame([("s", i, *map(float, (*p[i], *q[i]))) for i in range(60)], "s string, id int, p1x double, p1y double, p2x double, p2y double")
    fit = transforms.fit_affine_robust(df, ["s"], 0.5, trials=60).first()
    assert fit.n_inliers >= 45
    assert [fit.m[k] for k in transforms.MATRIX] == pytest.approx([1.1, 0.2, -0.1, 0.9, 3, -7], abs=1e-6)
    few = transforms.fit_affine_robust(df.limit(4), ["s"], 0.5).first()
    assert few.m is None and few.n_inliers == 0
    moved = transforms.transform_points(df.select("s", F.col("p1x").alias("x"), F.col("p1y").alias("y")), spark.createDataFrame([("s", fit.m)], transforms.fit_affine(df, ["s"]).select("s", "m").schema), ["s"])
    back = transforms.transform_points(moved, spark.createDataFrame([("s", fit.m)], transforms.fit_affine(df, ["s"]).select("s", "m").schema), ["s"], inverse=True)
    assert sorted(r.x for r in back.collect()) == pytest.approx(sorted(p[:, 0]))


def test_icp(spark):
    rng = np.random.default_rng(5)
    b = rng.uniform(0, 40, (80, 2))
    a = b + [0.4, -0.3]
    rows = lambda m: [("s", i, float(x), float(y)) for i, (x, y) in enumerate(m)]
    s = "s string, id int, x double, y double"
    m = transforms.icp(spark.createDataFrame(rows(a), s), spark.createDataFrame(rows(b), s), ["s"], max_dist=5.0, rounds=8).first().m
    assert [m[k] for k in transforms.MATRIX] == pytest.approx([1, 0, 0, 1, -0.4, 0.3], abs=1e-3)


def test_knn_doubles_until_certain(spark):
    a = spark.createDataFrame([(0, 0.0, 0.0), (1, 100.0, 0.0)], "id int, x double, y double")
    b = spark.createDataFrame([(i, float(i * i), 0.0) for i in range(6)], "id int, x double, y double")
    got = {(r.id, r.rank): (r.other, r.d) for r in joins.knn_join(a, b, 2).collect()}
    assert got == {(0, 1): (0, 0.0), (0, 2): (1, 1.0), (1, 1): (5, 75.0), (1, 2): (4, 84.0)}


def test_ssim_brute(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 255, (16, 18))
    y = x + rng.normal(0, 20, x.shape)
    table = lambda m: spark.createDataFrame([(i, j, float(m[i, j])) for i in range(16) for j in range(18)], "row int, col int, value double")
    vals = []
    for i in range(10):
        for j in range(12):
            u, v = x[i : i + 7, j : j + 7].ravel(), y[i : i + 7, j : j + 7].ravel()
            c = np.cov(u, v)
            vals.append((2 * u.mean() * v.mean() + 2.55**2) * (2 * c[0, 1] + 7.65**2) / ((u.mean() ** 2 + v.mean() ** 2 + 2.55**2) * (c[0, 0] + c[1, 1] + 7.65**2)))
    assert windows.ssim(table(x), table(y), 255.0).first().ssim == pytest.approx(np.mean(vals))


def test_p_values():
    assert scalars.t_pvalues(np.array([2.0, 0.0, 12.706]), np.array([10, 5, 1])) == pytest.approx([0.0733880, 1.0, 0.05], abs=1e-4)
    assert scalars.normal_pvalues([1.959964]) == pytest.approx([0.05], abs=1e-6)


def lattice(n=9):
    return [(i * n + j, i, j) for i in range(n) for j in range(n)]


def test_lag_model_recovers(spark):
    rng = np.random.default_rng(4)
    n = 14
    idx = lattice(n)
    W = np.array([[float(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1) for b in idx] for a in idx])
    x = rng.normal(size=n * n)
    y = np.linalg.solve(np.eye(n * n) - 0.15 * W, 1.0 + 2.0 * x + rng.normal(0, 0.3, n * n))
    df = spark.createDataFrame([("g", a, i, j, float(x[a]), float(y[a])) for a, i, j in idx], "g string, ims_idx int, ims_x int, ims_y int, x double, y double")
    d, names = models.design(df, [], "x")
    fit = {r.term: r for r in models.fit_lag(d, ["g"], "y", names, order=12, probes=24).collect()}
    assert fit["rho"].estimate == pytest.approx(0.15, abs=0.03)
    assert fit["x"].estimate == pytest.approx(2.0, abs=0.15) and fit["x"].p_value < 1e-6
    mom = models.trace_moments(df, ["g"], 8, 64).first().moments
    want = [np.trace(np.linalg.matrix_power(W, k)) / n**2 for k in range(1, 9)]
    assert mom[1] == pytest.approx(want[1]) and mom[3] == pytest.approx(want[3], rel=0.1)
    assert models.log_det(0.15, np.array(want)) == pytest.approx(np.linalg.slogdet(np.eye(n * n) - 0.15 * W)[1] / n**2, rel=0.05)
    tc = models.predict_tc(d, spark.createDataFrame([("g", t, v) for t, v in (("rho", 0.15), ("(Intercept)", 1.0), ("x", 2.0))], "g string, term string, estimate double"), ["g"], names)
    got = {r.ims_idx: r.predicted for r in tc.collect()}
    exact = np.linalg.solve(np.eye(n * n) - 0.15 * W, 1.0 + 2.0 * x)
    assert [got[a] for a, _, _ in idx] == pytest.approx(exact.tolist(), abs=1e-3)


def test_linear_models(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=200)
    y = 3 - 2 * x + rng.normal(0, 0.5, 200)
    rows = [("g", float(a), float(b), 1.0, float(math.exp(0.5 + 0.3 * a))) for a, b in zip(x, y)] + [("const", 1.0, 2.0, 1.0, 1.0)] * 5
    df = spark.createDataFrame(rows, "g string, x double, y double, one double, z double")
    ols = {(r.g, r.term): r for r in models.fit_ols(df, ["g"], "y", ["one", "x"]).collect()}
    coef, res = np.linalg.lstsq(np.c_[np.ones(200), x], y, rcond=None)[:2]
    assert [ols["g", "one"].estimate, ols["g", "x"].estimate] == pytest.approx(coef.tolist())
    se = math.sqrt(res[0] / 198 * np.linalg.inv(np.c_[np.ones(200), x].T @ np.c_[np.ones(200), x])[1, 1])
    assert ols["g", "x"].std_error == pytest.approx(se)
    assert ols["const", "x"].status == "singular" and ols["const", "x"].estimate is None
    glm = {r.term: r.estimate for r in models.fit_glm(df.where("g = 'g'"), ["g"], "z", ["one", "x"]).collect()}
    assert [glm["one"], glm["x"]] == pytest.approx([0.5, 0.3], abs=1e-5)
    far = df.where("g = 'g'").withColumn("y", F.when(F.rand(1) < 0.1, 500.0).otherwise(F.col("y")))
    rob = {r.term: r.estimate for r in models.fit_robust(far, ["g"], "y", ["one", "x"]).collect()}
    assert [rob["one"], rob["x"]] == pytest.approx([3, -2], abs=0.2)


def test_second_level_random(spark):
    rng = np.random.default_rng(8)
    rows, samples = [], []
    for s in range(30):
        g = s // 3
        rows.append((1.0, f"s{s}", "t", float(2 + math.sin(g) + rng.normal(0, 0.2)), 0.2, 50))
        samples.append((f"s{s}", f"p{g}"))
    fit = spark.createDataFrame(rows, "mz double, sample_id string, term string, estimate double, std_error double, n long")
    r = models.fit_second_random(fit, spark.createDataFrame(samples, "sample_id string, patient string"), "patient").first()
    assert r.status == "ok" and r.estimate == pytest.approx(2 + np.mean(np.sin(range(10))), abs=0.15) and 0.1 < r.tau2 < 1.5


def test_matching_operators(spark):
    m = spark.createDataFrame([(1, 10, 0.5), (1, 11, 0.2), (2, 11, 0.1), (3, 12, 0.4)], "id int, other int, d double")
    assert {(r.id, r.other) for r in graphs.one_to_one(m).collect()} == {(2, 11), (3, 12)}
    c = spark.createDataFrame([(1, 5, [0.0, 0.0], [0.1, 0.0]), (1, 6, [0.0, 0.0], [3.0, 4.0]), (2, 5, [1.0], [2.0]), (2, 6, [1.0], [0.1])], "id int, other int, a array<double>, b array<double>")
    assert [(r.id, r.other) for r in graphs.ratio_test(c).collect()] == [(1, 5)]
    with pytest.raises(ValueError):
        graphs.add_interactions(spark.createDataFrame([("a", 1)], "sample_id string, ims_idx int"), spark.createDataFrame([("b", 1)], "sample_id string, ims_idx int"))


def test_verdict_logic(spark):
    B = lambda v: F.lit(v).cast("boolean")
    one = spark.range(1)
    say = lambda c: one.select(c.alias("v")).first().v
    assert say(verdicts.overall_verdict(B(True), B(True), B(True), B(True), B(None))) is True
    assert say(verdicts.overall_verdict(B(False), B(True), B(True), B(None), B(False))) is None
    assert say(verdicts.overall_verdict(B(False), B(True), B(True), B(True), B(False))) is False
    assert say(verdicts.step_verdict([B(None), B(False)], B(None), B(None))) is None
    assert say(verdicts.step_verdict([B(None), B(False)], B(False), B(None))) is False


def test_files(spark, tmp_path):
    (tmp_path / "s1_metrics.json").write_text(json.dumps({"a_to_b_mean": "1.5", "a_to_b_n": "x"}))
    got = {(r.sample, r.metric): r.value for r in files.read_metric_json(spark, str(tmp_path / "*_metrics.json"), "_metrics.json$").collect()}
    assert got == {("s1", "a_to_b_mean"): 1.5, ("s1", "a_to_b_n"): None}
    feature = {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}, "properties": {"name": "A"}}
    (tmp_path / "one.geojson").write_text(json.dumps(feature))
    (tmp_path / "two.geojson").write_text(json.dumps([feature, {**feature, "properties": {"name": "B"}}], indent=1))
    loc = files.read_geojson(spark, str(tmp_path / "*.geojson"), "layer")
    assert sorted(r.name for r in loc.collect()) == ["A", "A", "B"] and len(loc.first().ring) == 4
    files.write_geojson(loc.where("name = 'B'"), str(tmp_path / "out"))
    assert files.read_geojson(spark, str(tmp_path / "out"), "x").first().name == "B"
    files.write_mz_slices(spark.createDataFrame([(1, 1001.0, 2.0), (2, 1002.0, 3.0)], files.TABLES["peaks"]), str(tmp_path / "mz"))
    assert spark.read.parquet(str(tmp_path / "mz")).where("mz = 1002").first().value == 3.0
    files.write_csv(spark.range(3), str(tmp_path / "csv"))
    assert files.read_csv_per_sample(spark, str(tmp_path / "csv" / "*.csv"), "-.*", "id long").count() == 3
    j = files.metric_json(spark.createDataFrame([("s", "m", 1.0), ("s", "k", None)], "sample string, metric string, value double"), "a_to_b").first()
    assert json.loads(j.value).get("a_to_b_m") == "1.0"


def test_lookups(spark):
    df = spark.createDataFrame([("a", "p", None, 0), ("b", "p", "x.imzML", 1)], "sample_name string, project_name string, coords_filename string, seq int")
    assert lookups.lookup(df, "project_name", "p", "coords_filename", order="seq").first()[0] == ""
    assert [r.coords_path for r in lookups.resolve_coords(df).orderBy("seq").collect()] == ["results/p/a_coords.parquet", "x.imzML"]
    raster = spark.createDataFrame([(1, 0, 0, 1.0), (2, 0, 0, 2.0)], "channel int, row int, col int, value double")
    panel = spark.createDataFrame([(1, "DNA"), (2, "CD3")], "channel int, name string")
    assert lookups.select_channels(raster, panel, ["CD3"]).first().value == 2.0
    with pytest.raises(ValueError):
        lookups.select_channels(raster, panel, ["none"])
    wide = spark.createDataFrame([("s", 1.0, 2.0)], "sample string, a_to_b_quantile50 double, b_to_c_n double")
    assert lookups.select_step(wide, "a_to_b").columns == ["sample", "Q50"]


def test_matches_thin_within_their_sample(spark):
    rng = random.Random(4)
    rows = [(s, i * 3 + s, rng.random() * 6, rng.random() * 6, rng.random() * 6, rng.random() * 6, rng.random()) for s in range(3) for i in range(4 if s == 2 else 40)]
    got = {r.id for r in graphs.thin_matches(spark.createDataFrame(rows, "sample int, id int, p1x double, p1y double, p2x double, p2y double, d double"), 1.0, keys=["sample"]).collect()}
    want = {r[1] for r in rows}
    for s in range(2):  # the third has fewer than five
        m = [r for r in rows if r[0] == s]
        while True:
            near = lambda a, b: math.dist(a[2:4], b[2:4]) < 1 or math.dist(a[4:6], b[4:6]) < 1
            lost = {a[1] for a in m for b in m if a != b and near(a, b) and (b[6], b[1]) < (a[6], a[1])}
            if not lost:
                break
            m, want = [r for r in m if r[1] not in lost], want - lost
    assert got == want


def test_queries_take_all_samples_and_pixels(spark, sf):
    from mosaica.plans.fixtures import fixture
    from mosaica.plans.queries_joins import QUERIES

    px = {r.ims_idx: (r.sample_id, r.ims_x, r.ims_y) for r in fixture(spark, sf, "pixels").collect()}
    at, region = {v: k for k, v in px.items()}, {}
    for i in sorted(px):
        todo = [] if i in region else [i]
        while todo:
            j = todo.pop()
            if region.setdefault(j, i) == i:
                s, x, y = px[j]
                todo += [at[p] for p in ((s, x + 1, y), (s, x - 1, y), (s, x, y + 1), (s, x, y - 1)) if p in at and at[p] not in region]
    assert {r.ims_idx: r.region for r in QUERIES["pixel_regions"](spark, sf).collect()} == region
    sample = {r.id: r.sample for r in fixture(spark, sf, "matches").collect()}
    assert {sample[r.id] for r in QUERIES["thin_matches"](spark, sf).collect()} == set(sample.values())


def test_match_pixels_by_group(spark):
    px = spark.createDataFrame([("a", 1, 0, 5), ("a", 2, 1, 5), ("b", 3, 0, 5), ("b", 4, 1, 7)], "s string, ims_idx int, x int, y int")
    at = spark.createDataFrame([("a", 5, 0), ("a", 5, 1), ("b", 0, 5), ("c", 1, 1)], "s string, x int, y int")
    assert {(r.s, r.ims_idx) for r in joins.match_pixels(px, at, ["s"]).collect()} == {("a", 1), ("a", 2), ("b", 3)}


def test_whole_job_queries(spark, sf):
    """The widened queries give a row for every row of their tables."""
    from mosaica.plans.catalog import QUERIES
    from mosaica.plans.fixtures import fixture

    assert QUERIES["match_pixels_swapped"](spark, sf).count() == fixture(spark, sf, "pixels").count()
    assert QUERIES["resample_shift"](spark, sf).count() == fixture(spark, sf, "raster").where("channel = 1").count()


def brute_components(values, t):
    """{first pixel: pixels} of the 4-connected components above t."""
    left, out = {p for p, v in values.items() if v is not None and v > t}, {}
    while left:
        first = min(left)
        part, todo = set(), [first]
        while todo:
            p = todo.pop()
            if p in left:
                left.discard(p)
                part.add(p)
                todo += [(p[0] + 1, p[1]), (p[0] - 1, p[1]), (p[0], p[1] + 1), (p[0], p[1] - 1)]
        out[first] = part
    return out


def test_components_at_all_thresholds(spark):
    """Random rasters over several tiles, and one component over all of them, against a flood fill for each threshold."""
    rng = np.random.default_rng(12)
    values = {("a", r, c): float(v) for (r, c), v in np.ndenumerate(rng.integers(0, 10, (90, 140)))} | {("b", r, c): 5.0 for r in range(70) for c in range(70)} | {("b", 0, 200): None, ("b", 1, 200): 5.0}
    df = spark.createDataFrame([(k, r, c, v) for (k, r, c), v in values.items()], "s string, row int, col int, value double")
    levels = [2, 3.5, 4, 5, 7, 9]
    got = {(r.s, r.threshold, r.component): r for r in rasters_at(df, levels).collect()}
    want = {}
    for s in "ab":
        for t in levels:
            for (r0, c0), part in brute_components({(r, c): v for (k, r, c), v in values.items() if k == s}, t).items():
                want[s, float(t), r0 << 32 | c0] = part
    assert set(got) == set(want)
    for k, part in want.items():
        r, (rows, cols) = got[k], zip(*part)
        assert (r.area, r.r0, r.c0, r.r1, r.c1) == (len(part), min(rows), min(cols), max(rows), max(cols)) and (r.c_row, r.c_col) == pytest.approx((np.mean(rows), np.mean(cols)))


def rasters_at(df, levels):
    return sweep.threshold_components(df, levels, ["s"])


def test_sweep_of_thresholds(spark):
    """Marks on a lattice of brightness 200 that a bright veil joins below 170: the sweep finds a threshold at which they are apart, as a plain loop does."""
    rng = np.random.default_rng(2)
    image = np.full((60, 60), 100.0)
    image[25:, :] = 170.0
    for r in range(8, 57, 8):
        for c in range(8, 57, 8):
            image[r - 1 : r + 2, c - 1 : c + 2] = 200 + rng.integers(0, 5)
    image = np.floor(image)
    edge = {(r, c): float(min(r, c) - 4) for r in range(60) for c in range(60)}
    df = spark.createDataFrame([("s", r, c, float(v)) for (r, c), v in np.ndenumerate(image)], "s string, row int, col int, value double")
    dist = spark.createDataFrame([("s", r, c, d) for (r, c), d in edge.items()], "s string, row int, col int, distance double")
    chosen, marks = sweep.sweep_thresholds(df, dist, pixel=8.0, resolution=1.0, step=8.0, low=155, high=186, keys=["s"])
    table = {}
    for t in range(144, 198):
        parts = [p for p in brute_components({(r, c): v for (r, c), v in np.ndenumerate(image)}, t).values() if math.pi < len(p) < 64]
        marked = [np.mean(list(p), axis=0) for p in parts]
        d = [edge[int(r), int(c)] / 8 for r, c in marked] if len(marked) >= 6 else []  # all lie on one lattice
        table[t] = (len(d), sum(x <= 2 for x in d), sum(1 / x for x in d if x))

    def best(ts):
        top = [max(table[t][i] for t in ts) or 1 for i in range(3)]
        return max(ts, key=lambda t: (round(2 * table[t][2] / top[2] + table[t][0] / top[0] + 4 * table[t][1] / top[1], 9), -t))

    t = best(range(155, 186, 10))
    t = best(range(t - 9, t + 10, 3))
    fine = range(t - 2, t + 3)
    row = chosen.collect()
    assert len(row) == 1 and row[0].threshold == best(fine) and row[0].n == max(table[t][0] for t in fine) == 49 and row[0].b == max(table[t][1] for t in fine)
    assert row[0].w == pytest.approx(max(table[t][2] for t in fine))
    assert sorted((round(m.x, 3), round(m.y, 3)) for m in marks.collect()) == sorted((float(c), float(r)) for r in range(1, 8) for c in range(1, 8))


def brute_knn(a, b, k):
    out = {}
    for g, i, x, y in a:
        if x is not None and y is not None and math.isfinite(x) and math.isfinite(y):
            near = sorted((math.hypot(x - u, y - v), o) for h, o, u, v in b if h == g and u is not None and v is not None and math.isfinite(u) and math.isfinite(v))
            out |= {(g, i, r + 1): (o, d) for r, (d, o) in enumerate(near[:k])}
    return out


def test_knn_without_a_radius(spark):
    """Clusters, a far outlier, points at one place, points without a place, groups with few or no partners."""
    rng = np.random.default_rng(9)
    clump = [("c", int(i), float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 0.01, (400, 2)))] + [("c", 400, 1e6, -3e6), ("c", 401, 5.0, 5.0)]
    same = [("s", i, 1.0, 1.0) for i in range(300)] + [("s", 300, 1.0, 1.5)]
    odd = [("c", 900, None, 1.0), ("c", 901, float("nan"), 1.0), ("c", 902, 1.0, float("inf"))]
    grid = [("g", i, float(i % 12), float(i // 12)) for i in range(144)]
    a = clump + same + odd + grid + [("few", 0, 0.0, 0.0), ("none", 0, 0.0, 0.0)]
    b = [(g, i + 10_000, x + 0.25 if x is not None else None, y) for g, i, x, y in clump + same + odd + grid] + [("few", 1, 100.0, 0.0), ("few", 2, -1.0, -1.0)]
    schema = "g string, id long, x double, y double"
    for k, side in ((1, 1.0), (5, 1e-2)):
        got = joins.knn_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), k, ["g"], start=side).collect()
        want = brute_knn(a, b, k)
        assert {(r.g, r.id, r.rank): r.other for r in got} == {key: o for key, (o, _) in want.items()}
        assert all(r.d == pytest.approx(want[r.g, r.id, r.rank][1]) for r in got)
    none = spark.createDataFrame([], schema)
    assert joins.knn_join(none, none, 2, ["g"]).count() == joins.knn_join(spark.createDataFrame(a, schema), none, 2, ["g"]).count() == 0


def test_grouped_quantiles(spark):
    """Against numpy: skewed groups, ties, null keys and values, groups without values."""
    rng = np.random.default_rng(3)
    rows = [("hot", float(v)) for v in np.round(rng.normal(size=3000), 2)] + [(f"g{i % 7}", float(i % 13)) for i in range(200)] + [(None, 1.0), (None, 4.0), ("none", None), ("one", 5.0), ("hot", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    groups: dict = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    for r in A.error_summary(df, ["k"], "v").collect():
        own = [v for v in groups[r.k] if v is not None]
        assert r.n == len(own)
        for q in (5, 25, 50, 75, 95):
            assert r[f"q{q:02d}"] == (pytest.approx(np.quantile(own, q / 100)) if own else None)
    whole = A.table_quantile(df, "v", 0.3, "q").first().q
    assert whole == pytest.approx(np.quantile([v for _, v in rows if v is not None], 0.3))
    masked = {r.k: r for r in A.error_summary_masked(df.withColumn("m", F.col("v") > 0), ["k"], "v", "m").collect()}
    assert masked["hot"].masked_q50 == pytest.approx(np.median([v for v in groups["hot"] if v is not None and v > 0])) and masked["none"].masked_q50 is None


def test_hull_in_a_tree(spark):
    rng = np.random.default_rng(4)
    turn = rng.uniform(0, 2 * np.pi, 3000)
    pts = [("disc", float(x), float(y)) for x, y in rng.normal(size=(5000, 2))] + [("ring", float(x), float(y)) for x, y in zip(np.cos(turn), np.sin(turn))] + [("line", float(i), 2.0 * i) for i in range(50)] + [("dot", 1.0, 1.0), ("disc", None, 1.0)]
    df = spark.createDataFrame(pts, "k string, x double, y double")
    for part in (4096, 64):
        rings = {r.k: [(p.x, p.y) for p in r.ring] for r in A.convex_hull(df, "k", part).collect()}
        for k in ("disc", "ring", "line", "dot"):
            assert rings[k] == A.hull_of([(x, y) for g, x, y in pts if g == k and x is not None])


def test_lag_on_a_strip_goes_beyond_a_quarter(spark):
    """A line of pixels: the largest eigenvalue is 2, so rho may reach a half."""
    rng = np.random.default_rng(11)
    n, rho = 300, 0.4
    W = np.eye(n, k=1) + np.eye(n, k=-1)
    x = rng.normal(size=n)
    y = np.linalg.solve(np.eye(n) - rho * W, 1 + 2 * x + 0.3 * rng.normal(size=n))
    df = spark.createDataFrame([("g", i, i, 0, float(a), float(b), 1.0) for i, (a, b) in enumerate(zip(x, y))], "g string, ims_idx int, ims_x int, ims_y int, x double, y double, one double")
    fit = {r.term: r for r in models.fit_lag(df, ["g"], "y", ["one", "x"]).collect()}
    assert abs(fit["rho"].estimate - rho) < 0.02 and abs(fit["x"].estimate - 2) < 0.1 and fit["rho"].status == "ok"
    moments = [np.trace(np.linalg.matrix_power(W, k)) / n for k in range(1, 13)]
    for r in (0.1, 0.3, 0.45):
        assert models.log_det(r, moments, 2.0) == pytest.approx(np.linalg.slogdet(np.eye(n) - r * W)[1] / n, rel=0.01)


def test_sorted_cell_tables(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("cell_idx"), F.lit("c").alias("v"))
    files.write_csv(df, str(tmp_path / "cells"), ["cell_idx"])
    parts = sorted((tmp_path / "cells").glob("part-*.csv"))
    read = [int(line.split(",")[0]) for p in parts for line in p.read_text().split() if not line.startswith("cell_idx")]
    assert read == list(range(5000))


def test_sequences_do_not_span_gaps(spark):
    """Closed lines with missing points, against a plain loop over all windows."""
    rng = np.random.default_rng(7)

    def outline(w, h):
        return [(x, 0) for x in range(w)] + [(w, y) for y in range(h)] + [(x, h) for x in range(w, 0, -1)] + [(0, y) for y in range(h, 0, -1)]

    full = [*outline(9, 6)]
    full[4:5] = [(4, 0), (4, 1), (5, 1), (5, 0)]  # a notch
    a = [("l", i, i, float(x) + rng.uniform(-0.05, 0.05), float(y)) for i, (x, y) in enumerate(full) if i not in (7, 20)] + [("s", 0, 100, 50.0, 50.0), ("s", 1, 101, 51.0, 50.0)]
    b = [("l", i, 1000 + i, float(x) + 0.1, float(y)) for i, (x, y) in enumerate(full) if i != 12]

    def windows_of(pts, lo, hi):
        out, lines = {}, {}
        for p in sorted(pts):
            lines.setdefault(p[0], []).append(p)
        for own in lines.values():
            n = len(own)
            steps = []
            for p, q in zip(own, own[1:] + own[:1]):
                dx, dy = q[3] - p[3], q[4] - p[4]
                t = math.degrees(math.atan2(dy, dx))
                steps.append(("RBLT"[round(t / 90) % 4], abs(math.hypot(dx, dy) - 1) <= 0.2 and abs(t - round(t / 90) * 90) <= 15))
            for i, p in enumerate(own):
                for before in range(hi + 1):
                    for after in range(hi + 1 - before):
                        if lo <= before + after < n:
                            w = [steps[(i + k) % n] for k in range(-before, after)]
                            if all(s[1] for s in w):
                                out[p[2], before, after] = ("".join(s[0] for s in w), p[3], p[4])
        return out

    wa, wb = windows_of(a, 2, 6), windows_of(b, 2, 6)
    votes: dict = {}
    for (i, bf, af), (code, x, y) in wa.items():
        hits = [o for (o, f, g), (c, u, v) in wb.items() if (f, g, c) == (bf, af, code) and math.hypot(x - u, y - v) <= 1.75]
        if len(hits) == 1:
            votes.setdefault(i, []).append((hits[0], bf + af))
    want = {i: (v[0][0], max(n for _, n in v)) for i, v in votes.items() if len({o for o, _ in v}) == 1}
    schema = "line string, seq int, id int, x double, y double"
    got = {r.id: (r.other, r.length) for r in graphs.sequence_match(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), 2, 6).collect()}
    assert got == want and len(want) > 10


def test_inconsistent_pairs_without_a_reach(spark):
    rng = np.random.default_rng(8)
    rows = [(g, i, float(x), float(y), float(d)) for g in "ab" for i, (x, y, d) in enumerate(zip(*rng.uniform(0, 30, (2, 80)), rng.uniform(0, 1.75, 80)))]
    want = {g: sum(abs(p[4] - q[4]) > 0.5 + 0.1 * math.hypot(p[2] - q[2], p[3] - q[3]) for i, p in enumerate(own) for q in own[i + 1 :]) for g in "ab" for own in [[r for r in rows if r[0] == g]]}
    got = graphs.inconsistent_pairs(spark.createDataFrame(rows, "g string, id int, x double, y double, d double"), ["g"])
    assert {r.g: r.n_bad for r in got.collect()} == want


def test_inconsistent_pairs_counts_far_pairs_too(spark, sf):
    """The query left out pairs farther apart than 1.5; cells are settled by their boxes or quartered, down to points of one place, and rows of one id are no pair."""
    from mosaica.plans.catalog import QUERIES

    def brute(rows):
        pairs = [(p, q) for i, p in enumerate(rows) for q in rows[i + 1 :] if p[1] != q[1]]
        return sum(abs(p[4] - q[4]) > 0.5 + 0.1 * math.sqrt((p[2] - q[2]) ** 2 + (p[3] - q[3]) ** 2) for p, q in pairs)

    pts = spark.sql(f"SELECT c_custkey AS i, abs(c_acctbal) % 1 AS f FROM parquet.`{sf}/customer.parquet`").collect()
    rows = [(r.i % 7, r.i, r.i % 40 + r.f, r.i // 40 + r.f, (r.i % 40 + r.f) - (r.i // 40 + r.f)) for r in pts]
    got = {r.grp: r.n_bad for r in QUERIES["inconsistent_pairs"](spark, sf).collect()}
    assert got == {g: brute([r for r in rows if r[0] == g]) for g in got} and len(got) == 7 and min(got.values()) > 0
    rng = np.random.default_rng(4)
    at = [(float(x), float(y), float(d)) for x, y, d in zip(*rng.uniform(0, 200, (2, 150)), rng.uniform(0, 30, 150))] + [(1.0, 1.0, 3.0)] * 40 + [(7.0, 9.0, 1.5)] * 40
    rows = [("a", i, *p) for i, p in enumerate(at)] + [("a", i, 9.0, 9.0, 40.0) for i in range(0, 30, 2)] + [("b", 1, 0.0, 0.0, 0.0), ("b", 1, 0.0, 0.0, 9.0), ("c", 1, 0.0, 0.0, 0.0), ("c", 2, 5.0, 0.0, 1.0)]
    none = [("a", 900, None, 0.0, 1.0), ("a", None, 0.0, 0.0, 99.0), ("a", 901, float("nan"), 0.0, 99.0), (None, 1, 0.0, 0.0, 0.0), (None, 2, 0.0, 0.0, 9.0)]
    out = graphs.inconsistent_pairs(spark.createDataFrame(rows + none, "g string, id int, x double, y double, d double"), ["g"], few=20)
    assert {r.g: r.n_bad for r in out.collect()} == {"a": brute([r for r in rows if r[0] == "a"]), "c": 0}


def irregular_region(seed, side=14, share=0.8):
    """(pixels, W) of a ragged region with isolated pixels."""
    rng = np.random.default_rng(seed)
    px = [(x, y) for x in range(side) for y in range(side) if rng.random() < share] + [(side + 5, 0)]
    W = np.array([[float(abs(a - c) + abs(b - d) == 1) for c, d in px] for a, b in px])
    return px, W


def test_lag_solver_against_dense(spark):
    """At 0.98 of the bound, far below it, with negative rho, and beyond it."""
    px, W = irregular_region(1)
    most = np.abs(np.linalg.eigvalsh(W)).max()
    rng = np.random.default_rng(1)
    rhs = rng.normal(size=len(px))
    bound = models.spectral_bound(spark.createDataFrame([("g", i, x, y) for i, (x, y) in enumerate(px)], "g string, ims_idx int, ims_x int, ims_y int"), ["g"]).first().radius
    assert most <= bound < 1.2 * most
    rhos = {"near": 0.98 / bound, "far": 0.05, "negative": -0.7 / bound, "zero": 0.0, "beyond": 1.1 / bound}
    rows = [(g, i, x, y, float(rhs[i]), rho, float(bound)) for g, rho in rhos.items() for i, (x, y) in enumerate(px)]
    df = spark.createDataFrame(rows, "g string, ims_idx int, ims_x int, ims_y int, b double, rho double, radius double")
    got: dict = {}
    for r in models.solve_lag(df, ["g"], "b", tol=1e-5).collect():
        got.setdefault(r.g, {})[r.ims_idx] = (r.u, r.status)
    for g, rho in rhos.items():
        if g == "beyond":
            assert all(v == (None, "outside") for v in got[g].values())
        else:
            want = np.linalg.solve(np.eye(len(px)) - rho * W, rhs)
            assert [got[g][i][0] for i in range(len(px))] == pytest.approx(want, rel=1e-3, abs=1e-4) and got[g][0][1] == "ok"


def test_impacts_against_dense(spark):
    """Effects on an irregular region equal dense algebra; their errors and p-values come from the draws."""
    px, W = irregular_region(2)
    n = len(px)
    rng = np.random.default_rng(2)
    x = rng.normal(size=n)
    y = np.linalg.solve(np.eye(n) - 0.18 * W, 1 + 2 * x + 0.2 * rng.normal(size=n))
    df = spark.createDataFrame([("g", i, a, b, float(x[i]), float(y[i]), 1.0) for i, (a, b) in enumerate(px)], "g string, ims_idx int, ims_x int, ims_y int, x double, y double, one double")
    fit = models.fit_lag(df, ["g"], "y", ["one", "x"])
    e = {r.term: r for r in fit.collect()}
    rho, b = e["rho"].estimate, e["x"].estimate
    inverse = np.linalg.inv(np.eye(n) - rho * W)
    r = models.impacts(fit, df, ["g"], "x").first()
    assert r.direct == pytest.approx(b * np.trace(inverse) / n, rel=1e-6)
    assert r.total == pytest.approx(b * inverse.sum() / n, abs=r.total_remainder + 1e-6) and r.total_remainder < 1e-4 * abs(r.total)
    assert r.indirect == pytest.approx(r.total - r.direct) and r.rho == pytest.approx(rho, rel=1e-5) and r.sse == pytest.approx(e["x"].sigma2 * n)
    draws = np.random.default_rng(0)
    totals = [(b + e["x"].std_error * draws.standard_normal()) * np.linalg.solve(np.eye(n) - (rho + e["rho"].std_error * draws.standard_normal()) * W, np.ones(n)).sum() / n for _ in range(400)]
    assert r.total_se == pytest.approx(np.std(totals), rel=0.2) and r.total_p < 1e-6 and r.rho_p == pytest.approx(e["rho"].p_value, abs=1e-6)
    likelihood = -n / 2 * (np.log(2 * np.pi * e["x"].sigma2) + 1) + np.linalg.slogdet(np.eye(n) - rho * W)[1]
    assert r.log_likelihood == pytest.approx(likelihood)
    large = models.impacts(models.fit_lag(df, ["g"], "y", ["one", "x"], exact=10), df, ["g"], "x", exact=10).first()  # by trace moments
    assert large.direct == pytest.approx(r.direct, rel=0.02) and large.total == pytest.approx(r.total, rel=0.05)


def test_unsettled_point_sets_raise(spark, monkeypatch):
    monkeypatch.setattr(graphs, "MAX_ROUNDS", 0)
    a = spark.createDataFrame([(1, 0.0, 0.0)], "id int, x double, y double")
    with pytest.raises(RuntimeError):
        graphs.merge_points(a, a.withColumn("id", F.lit(2)))


def test_lookup_takes_the_first_row_of_the_sheet(spark):
    sheet = spark.createDataFrame([(0, "p", "z"), (1, "p", "a")], "seq int, project string, core string")
    assert lookups.lookup(sheet, "project", "p", "core").first()[0] == "z"
    assert lookups.mz_columns(sheet.withColumns({"1001.2": F.lit(1), "X2000": F.lit(1), "123": F.lit(1)})) == ["1001.2", "X2000"]


def test_checkpoint_folder_is_refused_on_a_cluster(monkeypatch):
    from mosaica.operators import lineage

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        lineage.checkpoint_dir(Session())


def brute_moves(points, pixels, moves, box, least):
    """{candidate: (coverage, matches, mean distance, mean weighted distance)} by moving every pixel."""
    out = {}
    for c, dx, dy, turn in moves:
        a = math.radians(turn)
        at = [(x * math.cos(a) - y * math.sin(a) + dx, x * math.sin(a) + y * math.cos(a) + dy) for _, x, y in pixels]
        share = sum(box[0] <= x <= box[2] and box[1] <= y <= box[3] for x, y in at) / len(at)
        best = {}
        for x, y in at:
            near = min(((math.hypot(x - px, y - py), i) for i, px, py, _ in points), default=(9, 0))
            if near[0] <= 1:
                best[near[1]] = min(best.get(near[1], 9), near[0])
        if share >= least and best:
            w = {i: v for i, _, _, v in points}
            out[c] = (share, len(best), sum(best.values()) / len(best), sum(d * w[i] for i, d in best.items()) / len(best))
    return out


def test_grid_search_prunes_without_changing_results(spark):
    rng = random.Random(5)
    pixels = [(i, i % 30 + 0.2 * rng.random(), i // 30 + 0.2 * rng.random()) for i in range(600)]
    points = [(i, 30 * rng.random(), 20 * rng.random(), 1.0 + i % 3) for i in range(90)]
    moves = [(i, 8.0 * rng.random() - 4, 8.0 * rng.random() - 4, 20.0 * rng.random() - 10) for i in range(25)]
    box = (-2.0, -2.0, 31.5, 21.5)
    px = spark.createDataFrame([*pixels, (9001, None, 1.0), (9002, float("nan"), 1.0)], "id int, x double, y double")
    pts = spark.createDataFrame([*points, (9001, None, 1.0, 1.0)], "id int, x double, y double, weight double")
    grid = spark.createDataFrame(moves, "candidate int, dx double, dy double, rotation double")
    corners = [(box[0], box[1]), (box[2], box[1]), (box[2], box[3]), (box[0], box[3]), (box[0], box[1])]
    outline = spark.createDataFrame([([{"x": x, "y": y} for x, y in corners],)], "ring array<struct<x:double,y:double>>")
    for least in (0.0, 0.9):
        want = brute_moves(points, pixels, moves, box, least)
        got = {r.candidate: (r.coverage, r.n_matches, r.mean_distance, r.weighted_distance) for r in transforms.grid_search(pts, px, grid, outline, least).collect()}
        assert got.keys() == want.keys() and (least == 0 or 0 < len(want) < len(moves))
        for c, v in want.items():
            assert got[c] == pytest.approx(v)
    for tile in (0.5, 3.0, 1000.0):
        shares = {r.candidate: r.coverage for r in transforms.outline_coverage(px, grid, outline, 0.0, tile).collect()}
        assert shares == pytest.approx({c: v[0] for c, v in brute_moves(points, pixels, moves, box, 0.0).items()})
    assert transforms.grid_search(pts, px.where("false"), grid, outline).collect() == []
    assert transforms.grid_search(pts.where("false"), px, grid).collect() == []


def test_density_balanced_sample(spark):
    rng = random.Random(3)
    rows = [(i, rng.random() * (0.4 if i % 2 else 4), rng.random() * (0.4 if i % 2 else 4)) for i in range(400)]
    m = spark.createDataFrame(rows, "id long, x double, y double")
    keys = {r.id: r.u for r in m.select("id", ((F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 52)) + 1) / float((1 << 52) + 1)).alias("u")).collect()}

    def key(i, x, y):
        near = (math.hypot(x - a, y - b) for _, a, b in rows)
        density = sum(math.exp(-d * d / 0.02) for d in near if d <= 0.4)
        return math.log(keys[i]) / (1e-7 if density < 10 else 1 / (density + 1))

    want = sorted(rows, key=lambda r: -key(*r))[:60]
    got = graphs.density_balanced_sample(m.repartition(5), 60, 7).collect()
    assert {r.id for r in got} == {r[0] for r in want} and len(got) == 60
    assert graphs.density_balanced_sample(m, 1000, 7).count() == 400


def test_sample_cap_is_the_same_on_any_partitioning(spark):
    m = spark.range(500)
    one, other = ({r.id for r in windows.sample_cap(m.repartition(n), 40, 3, "id").collect()} for n in (1, 7))
    assert one == other and len(one) == 40 and one != {r.id for r in windows.sample_cap(m, 40, 4, "id").collect()}
    assert windows.sample_cap(m, 900, 3, "id").count() == 500 and windows.sample_cap(m.where("false"), 9, 3, "id").count() == 0


def test_labels_repeat_in_samples(spark):
    labels = spark.createDataFrame([("a", 0, 0, 1), ("b", 0, 0, 1), ("b", 0, 1, 1), ("c", 0, 0, 1), ("a", 1, 1, 0)], "sample_id string, row int, col int, label int")
    raster = spark.createDataFrame([("a", 1, 0, 0, 5.0), ("b", 1, 0, 0, 1.0), ("b", 1, 0, 1, 2.0)], "sample_id string, channel int, row int, col int, value double")
    got = {r.sample_id: r["1"] for r in A.label_means(labels, raster, [1], ["sample_id"]).collect()}
    assert got == {"a": 5.0, "b": 1.5, "c": None}


def test_modes_and_shapes_with_nothing_to_go_by(spark):
    files = spark.createDataFrame([("automatic.h5",), ("x.h5",), (None,)], "coords_filename string")
    for ids, want in (([1, 1], [True, True, True]), ([1, 2], [True, False, False]), ([], [True, False, False])):
        regions = spark.createDataFrame([(i,) for i in ids], "region int")
        assert [r.by_location for r in graphs.index_mode(files, regions).collect()] == want
    c = spark.createDataFrame([(1, 5, 2.0), (1, 4, 2.0), (1, 3, None), (2, 1, None)], "id int, other int, shape_distance double")
    assert [tuple(r) for r in graphs.best_shape_match(c).collect()] == [(1, 4, 2.0)]


@pytest.mark.parametrize("name", ["mutual_nn", "region_candidates", "score_shifts", "radius_self_join", "inconsistent_pairs", "interaction_terms", "mark_metrics", "knn_join"])
def test_spatial_joins_put_no_points_on_the_driver(spark, sf, name):
    """A few compressed bytes become many rows in the cells around a point; what follows the size of the file must not decide on a broadcast."""
    from mosaica.plans.catalog import QUERIES

    plan = QUERIES[name](spark, sf)._jdf.queryExecution().sparkPlan().toString().splitlines()
    met = [line for line in plan if "Join" in line and "_bx" in line]
    assert met and not [line for line in met if "Broadcast" in line]


@pytest.mark.parametrize("name", ["one_to_one", "radius_join"])
def test_points_meet_in_shuffled_joins_alone(spark, sf, name):
    """Where the points' file is small they were broadcast, and the few tasks that read the other side held all pairs."""
    from mosaica.plans.catalog import QUERIES

    plan = QUERIES[name](spark, sf)._jdf.queryExecution().sparkPlan().toString().splitlines()
    joined = [line for line in plan if "Join" in line]
    assert len(joined) == 1 and "SortMergeJoin" in joined[0]


def test_reindex_region_broadcasts_no_pixels(spark, sf):
    """All pixels went to the driver where their file was small."""
    from mosaica.plans.catalog import QUERIES

    plan = QUERIES["reindex_region"](spark, sf)._jdf.queryExecution().sparkPlan().toString().splitlines()
    joined = [line for line in plan if "Join" in line]
    assert len(joined) >= 3 and not [line for line in joined if "Broadcast" in line]


def test_knn_join_sorts_the_near_pairs_of_a_point_alone(spark):
    """All pairs within max_dist were sorted, 28 of a point in the query."""
    a = [("g", i, i % 7 * 0.25, i % 5 * 0.5) for i in range(40)] + [("h", 99, 0.0, 0.0), (None, 7, 0.0, 0.0), ("g", 50, None, 0.0)]
    b = [("g", f"b{i:03}", i % 13 * 0.25, i % 11 * 0.25) for i in range(600)] + [("h", "z", 9.0, 9.0)]
    schema = "g string, id {}, x double, y double"
    dfa, dfb = spark.createDataFrame(a, schema.format("int")), spark.createDataFrame(b, schema.format("string"))
    want = {}
    for g, i, x, y in a:
        near = sorted((math.hypot(x - p[2], y - p[3]), p[1]) for p in b if p[0] == g and x is not None and math.hypot(x - p[2], y - p[3]) <= 1.5)
        want |= {(g, i, rank): pair for rank, pair in enumerate(near[:3], 1)}
    out = joins.knn_join(dfa, dfb, 3, ["g"], max_dist=1.5)
    assert out.columns == ["g", "id", "other", "d", "rank"]
    assert {(r.g, r.id, r["rank"]): (r.d, r.other) for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("MapInArrow") < plan.index("Join")
    batch = pa.record_batch({"id": ["a"] * 5 + ["b"] * 2, "d": [3.0, 1.0, 2.0, 2.0, 5.0, 4.0, 3.0], "_n": [4] * 5 + [9] * 2})
    kept = [x.to_pydict() for x in joins._nearest_of_batch(iter([batch, batch.slice(0, 0), batch.slice(4, 2)]), 2)]
    assert kept == [{"id": ["a", "a", "a", "b", "b"], "d": [1.0, 2.0, 2.0, 4.0, 3.0]}, {"id": [], "d": []}, {"id": ["a", "b"], "d": [5.0, 4.0]}]


def test_ratio_test_carries_descriptors_through_the_one_join(spark, sf):
    """Pairs were joined with the descriptors of both sides again, which were broadcast where their file was small."""
    from mosaica.plans.catalog import QUERIES

    plan = QUERIES["ratio_test"](spark, sf)._jdf.queryExecution().sparkPlan().toString().splitlines()
    joined = [line for line in plan if "Join" in line]
    assert len(joined) == 1 and "Broadcast" not in joined[0]
    points = spark.createDataFrame([(1, 0.0, 0.0, [1.0], "p"), (2, 5.0, 5.0, [2.0], None)], "id int, x double, y double, v array<double>, name string")
    near = points.selectExpr("id + 10 AS id", "x + 0.5 AS x", "y", "v AS w")
    assert {tuple(map(str, r)) for r in joins.descriptor_candidates(points, near, 1.0, "v", "w").collect()} == {("1", "11", "0.5", "[1.0]", "[1.0]"), ("2", "12", "0.5", "[2.0]", "[2.0]")}
    assert joins.descriptor_candidates(points, near, 1.0).columns == ["id", "other", "d"]
    assert {(r.id, r.name) for r in joins.radius_join(points, near, 1.0, carry=["name"]).collect()} == {(1, "p"), (2, None)}


def test_radius_self_join_gives_every_pair_once_with_what_it_carries(spark):
    rows = [("g", i, (i * 7 % 11) * 0.5 - 2.0, (i * 5 % 13) * 0.5 - 3.0, f"n{i}") for i in range(60)] + [("h", 100, 0.0, 0.0, "a"), ("h", 101, 0.0, 0.0, "b"), ("h", 102, None, 0.0, "c")]
    got = joins.radius_self_join(spark.createDataFrame(rows, "g string, id int, x double, y double, name string"), 1.0, ["g"], ["name"]).collect()
    want = {(a[1], b[1]): (a[4], b[4]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and None not in (a[2], b[2]) and math.hypot(a[2] - b[2], a[3] - b[3]) <= 1.0}
    assert len(got) == len(want) and {(r.id, r.other): (r.name, r.other_name) for r in got} == want


def test_radius_self_join_copies_points_to_cells_within_reach_alone(spark, monkeypatch):
    """Every point went to five cells. Pairs at r exactly, over the corners of cells and below 0, are kept."""
    rng = np.random.default_rng(9)
    at = [(float(x), float(y)) for x, y in rng.uniform(-20, 20, (400, 2))] + [(float(x), float(y)) for x in range(-9, 10, 3) for y in range(-9, 10, 3)] + [(1e9, -1e9), (1e9 + 3, -1e9)]
    out = joins.radius_self_join(spark.createDataFrame([(i, *p) for i, p in enumerate(at)], "id int, x double, y double"), 3.0)
    want = {(i, j) for i, p in enumerate(at) for j, q in enumerate(at) if i < j and math.hypot(p[0] - q[0], p[1] - q[1]) <= 3.0}
    got = [(r.id, r.other) for r in out.collect()]
    assert len(got) == len(want) and set(got) == want and (len(at) - 2, len(at) - 1) in want
    copies = []
    monkeypatch.setattr(joins, "unbroadcast", lambda df: copies.append(df) or df.hint("merge"))
    joins.radius_self_join(spark.range(10_000).selectExpr("id", "(id % 100) * 0.73 AS x", "(id div 100) * 0.77 AS y"), 0.1)
    assert len(copies) == 1 and copies[0].count() < 30_000


def test_interaction_terms_of_places_that_hold_many_cells(spark):
    """All pairs of cells were made, so work grew with the square of the cells of a place; places, types, pixels and values are summed before the join."""
    rng = np.random.default_rng(6)
    cells = [("s", i, float(i % 5) * 1.5, float(i % 3), "ABC"[int(rng.integers(3))], float(rng.uniform(-1, 3))) for i in range(120)]
    cells += [("s", 500, 0.0, 0.0, None, 2.0), ("s", 501, 0.0, 0.0, "D", 5.0), ("s", 502, 0.0, 0.0, "A", None), ("s", 503, None, 0.0, "A", 1.0), ("s", 504, float("nan"), 0.0, "A", 1.0), ("s", 505, 0.0, 0.0, "A", 1e9), ("t", 1, 0.0, 0.0, "A", 1.0)]
    px = [("s", c[1], c[1] % 4) for c in cells if c[0] == "s"] + [("s", 0, 9), ("t", 1, 3), ("t", 77, 8)]
    last = {}
    for g, i, p in px:
        last[g, i] = max(p, last.get((g, i), p))
    want = {}
    known = [c for c in cells if c[2] is not None and c[5] is not None and c[4] != "D"]
    for i, a in enumerate(known):
        for b in known[i + 1 :]:
            if a[0] == b[0] and math.hypot(a[2] - b[2], a[3] - b[3]) <= 2.0:
                kinds = sorted(k for k in (a[4], b[4]) if k) * 2
                for c in (a, b):
                    k = (c[0], last[c[0], c[1]], f"{kinds[0]}:{kinds[1] if a[4] and b[4] else kinds[0]}")
                    want[k] = want.get(k, 0.0) + a[5] * b[5]
    df = spark.createDataFrame(cells, "sample_id string, id int, x double, y double, celltype string, value double")
    out = graphs.interaction_terms(df, spark.createDataFrame(px, "sample_id string, id int, ims_idx int"), ["C", "A", "B"], 2.0)
    assert out.columns == ["sample_id", "ims_idx", "A:A", "A:B", "A:C", "B:B", "B:C", "C:C"]
    got = {(r.sample_id, r.ims_idx, c): r[c] for r in out.collect() for c in out.columns[2:]}
    assert {k[:2] for k in got} == {(g, p) for g, _, p in px}
    for k, v in got.items():
        assert math.isclose(v, want.get(k, 0.0), rel_tol=1e-9, abs_tol=1e-9), k
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if "Join" in line and "_bx" in line)
    assert len([line for line in plan[join:] if re.search(r"Aggregate \[sample_id#\d+, x#\d+, y#\d+\]", line)]) == 2


def test_fill_updown_takes_time_in_proportion_to_the_rows(spark):
    """A frame that shrinks from row to row would be gone through 60,000 times in the one group."""
    df = spark.range(60_000).select(F.lit("g").alias("g"), "id", F.when(F.col("id") == 59_990, F.lit("x")).alias("v"))
    out = windows.fill_updown(df, ["v"], ["g"], "id")
    assert "unboundedfollowing" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert out.where("v = 'x'").count() == 60_000


def test_robust_affine_ranks_few_points_and_repeated_ids_too(spark):
    """Groups of many points, of one repeated id and of two points: the draw is that of ranking every point of a group for every trial."""
    rows = [("a", i, float(i % 97), float(i % 89), 2.0 * (i % 97) + 1 + (50 if i % 5 == 0 else 0), float(i % 89) - 3) for i in range(3000)]
    rows += [("b", 7, float(i % 13), float(i % 11), float(i % 13) + 4, float(i % 11)) for i in range(500)] + [("c", 1, 0.0, 0.0, 1.0, 1.0), ("c", 2, 1.0, 0.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "s string, id int, p1x double, p1y double, p2x double, p2y double").repartition(5)
    fit = transforms.fit_affine_robust(df, ["s"], 0.5, trials=30)
    got = {r.s: r for r in fit.collect()}
    assert (got["a"].n, got["a"].n_inliers) == (3000, 2400) and abs(got["a"].m.a - 2) < 1e-9 and abs(got["a"].m.tx - 1) < 1e-6
    assert got["b"].n_inliers in (0, 500) and (got["c"].n_inliers, got["c"].m) == (0, None)
    joins_ = [line for line in fit._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert joins_ and not [line for line in joins_ if "trial" in line]  # rows of points times trials are not shuffled


def test_standardise_takes_no_group_into_a_task(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), (None, 2.0), (None, 6.0), ("b", 5.0)]
    out = A.standardise(spark.createDataFrame(rows, "g string, v double"), "v", ["g"])
    assert out.columns == ["g", "v", "z"] and "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.g, r.v): r.z for r in out.collect()}
    k = 2**-0.5
    assert {x: z if z is None else round(z, 9) for x, z in got.items()} == {("a", 1.0): round(-k, 9), ("a", 3.0): round(k, 9), ("a", None): None, (None, 2.0): round(-k, 9), (None, 6.0): round(k, 9), ("b", 5.0): None}


def test_match_locations_pairs_meet_once_and_are_clipped_only_where_needed(spark):
    box = lambda x, y, h: [(x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h), (x - h, y - h)]
    rows = lambda items: spark.createDataFrame(items, "name string, ring array<struct<x:double,y:double>>")
    diamond = [(0.0, 40.0), (40.0, 0.0), (0.0, -40.0), (-40.0, 0.0), (0.0, 40.0)]  # clockwise
    outer = rows([("d", diamond), ("e", box(100.0, 0.0, 30.0)), ("f", box(130.0, 0.0, 30.0))])
    inner = rows([
        ("in", box(0.0, 0.0, 15.0)), ("corner", box(30.0, 30.0, 4.0)), ("half", box(20.0, 20.0, 5.0)), ("both", box(115.0, 0.0, 5.0)), ("out", box(-300.0, 0.0, 5.0)),
        ("line", [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]), ("same", box(0.0, 0.0, 1.0)), ("same", box(1.0, 0.0, 1.0)),
    ])
    for tile in (7.0, 1000.0):
        got = {r.name: (r.outer_name, r.n_found) for r in joins.match_locations(inner, outer, 0.45, tile).collect()}
        assert got == {"in": ("d", 1), "corner": (None, 0), "half": ("d", 1), "both": (None, 2), "out": (None, 0), "line": (None, 0), "same": ("d", 1)}
    # pairs of names are not shuffled with their rings, and no ring is sorted
    plan = joins.match_locations(inner, outer, 0.45, 7.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Deduplicate" not in plan and "first(name_ring" not in plan

def test_metric_lines_need_no_file_a_sample(spark, tmp_path):
    long = spark.range(300).selectExpr("case when id = 7 then null else concat('s \"', id) end AS sample", "'dice' AS metric", "id / 7 AS value").cache()
    want = {(r.sample, "a_to_b_dice", r.value) for r in long.collect()}
    files.write_metric_json(long, str(tmp_path / "lines"), "a_to_b", lines=True)
    assert {tuple(r) for r in files.read_metric_json(spark, str(tmp_path / "lines"), "", lines=True).collect()} == want
    assert len(list((tmp_path / "lines").glob("**/part-*"))) < 20
    few = long.where("sample like 's \"1'").selectExpr("'one' AS sample", "metric", "value")
    files.write_metric_json(few, str(tmp_path / "files"), "a_to_b")
    assert [p.parent.name for p in (tmp_path / "files").glob("**/part-*")] == ["sample=one"]


def test_footprint_deals_pixels_before_they_are_spread(spark):
    px = spark.range(3000, numPartitions=1).selectExpr("id AS seq", "cast(id * 7 % 300 AS int) AS row", "cast(id * 11 % 200 AS int) AS col", "id * 2 AS value")
    out = rasters.footprint(px, 4)
    want = {}
    for p in px.orderBy("seq").collect():
        want |= {(p.row + i, p.col + j): p.value for i in range(-2, 3) for j in range(-2, 3)}
    assert {(r.row, r.col): r.value for r in out.collect()} == want
    spread = out._jdf.queryExecution().optimizedPlan().toString()
    assert spread.index("Generate") < spread.index("RepartitionByExpression")


def test_pixels_of_a_group_without_fit_stay_without_a_prediction(spark):
    d = spark.createDataFrame([(g, i, i, 0, 1.0) for g in "ab" for i in range(3)] + [("c", 0, 0, 0, 1.0)], "g string, ims_idx int, ims_x int, ims_y int, x double")
    fit = spark.createDataFrame([("a", "rho", 0.1), ("a", "x", 2.0), ("b", "rho", None), ("b", "x", None)], "g string, term string, estimate double")
    got = {(r.g, r.ims_idx): (r.predicted, r.status) for r in models.predict_tc(d, fit, ["g"], ["x"]).collect()}
    u = np.linalg.solve(np.eye(3) - 0.1 * np.array([[0, 1, 0], [1, 0, 1], [0, 1, 0]]), np.full(3, 2.0))
    assert [got["a", i][0] for i in range(3)] == pytest.approx(u.tolist()) and got["a", 0][1] == "ok"
    assert len(got) == 7 and {got[k] for k in got if k[0] != "a"} == {(None, "no fit")}
