"""Queries for joins, neighbourhoods and transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaica.functions import geometry as G
from mosaica.operators import graphs, joins, transforms
from mosaica.plans.fixtures import cells, fixture, with_sql

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _r(*names: str, digits: int = 6):
    return [F.round(n, digits).alias(n) for n in names]


def _positions(spark, sf_dir) -> DataFrame:
    return fixture(spark, sf_dir, "pixels").select("sample_id", "ims_idx", F.col("ims_x").cast("double").alias("x"), F.col("ims_y").cast("double").alias("y"))


@query(with_sql("pixels", "boxes") + """
, c AS (SELECT sample_id, cell_idx, cx, cy, half FROM boxes),
p AS (SELECT sample_id, ims_idx, ims_x * 100 + 45 - 40.5 AS x0, ims_y * 100 + 45 - 40.5 AS y0 FROM pixels),
o AS (SELECT sample_id, cell_idx, ims_idx, half,
  greatest(0, least(cx + half, x0 + 81) - greatest(cx - half, x0)) AS w, greatest(0, least(cy + half, y0 + 81) - greatest(cy - half, y0)) AS h
  FROM c JOIN p USING (sample_id) WHERE sqrt((cx - x0 - 40.5) ** 2 + (cy - y0 - 40.5) ** 2) < 200)
SELECT sample_id, cell_idx, ims_idx, round(w * h / (4 * half * half), 6) AS overlap, round(4 * half * half / 10000, 6) AS cell_area
FROM o WHERE w * h / (4 * half * half) > 0.000001""")
def cell_pixel_overlap(spark, sf_dir):
    out = joins.cell_pixel_overlap(cells(spark, sf_dir), _positions(spark, sf_dir), 1.0, 0.9, 2.0)
    return out.where("overlap > 0.000001").select("sample_id", "cell_idx", "ims_idx", *_r("overlap", "cell_area"))


@query(with_sql("boxes") + " SELECT sample_id, cell_idx, round(cx / 100, 6) AS x, round(cy / 100, 6) AS y, round(4 * half * half / 10000, 6) AS area FROM boxes")
def cell_centroids(spark, sf_dir):
    c = G.ring_centroid(F.col("ring"))
    return cells(spark, sf_dir).select("sample_id", "cell_idx", c.alias("c"), G.ring_area(F.col("ring")).alias("area")).select("sample_id", "cell_idx", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"), *_r("area"))


@query(with_sql("points_a", "points_b") + """
SELECT a.id, b.id AS other, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6) AS d FROM points_a a JOIN points_b b
ON abs(a.x - b.x) <= 1.3 AND abs(a.y - b.y) <= 1.3 AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 1.3""")
def radius_join(spark, sf_dir):
    return joins.radius_join(fixture(spark, sf_dir, "points_a"), fixture(spark, sf_dir, "points_b"), 1.3).select("id", "other", *_r("d"))


_KNN = with_sql("points_a", "points_b") + """
, d AS (SELECT a.id, b.id AS other, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d FROM points_a a JOIN points_b b ON abs(a.x - b.x) <= 3 AND abs(a.y - b.y) <= 3),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, other) AS rank FROM d WHERE d <= 3)
SELECT id, other, round(d, 6) AS d, CAST(rank AS INT) AS rank FROM r WHERE rank <= 3"""


@query(_KNN)
def knn_join(spark, sf_dir):
    return joins.knn_join(fixture(spark, sf_dir, "points_a"), fixture(spark, sf_dir, "points_b"), 3, max_dist=3.0).select("id", "other", *_r("d"), "rank")


@query(_KNN)
def knn_join_unbounded(spark, sf_dir):
    return joins.knn_join(fixture(spark, sf_dir, "points_a"), fixture(spark, sf_dir, "points_b"), 3, start=0.5).select("id", "other", *_r("d"), "rank")


@query(with_sql("points_a", "points_b") + """
, d AS (SELECT a.id, b.id AS other, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d FROM points_a a JOIN points_b b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, other) AS ra, row_number() OVER (PARTITION BY other ORDER BY d, id) AS rb FROM d WHERE d <= 1)
SELECT id, other, round(d, 6) AS d FROM r WHERE ra = 1 AND rb = 1""")
def mutual_nn(spark, sf_dir):
    return joins.mutual_nn(fixture(spark, sf_dir, "points_a"), fixture(spark, sf_dir, "points_b"), 1.0).select("id", "other", *_r("d"))


@query(with_sql("spectra", "peaklist") + """
, a AS (SELECT s.ims_idx, s.mz, s.intensity, p.mz AS ref, row_number() OVER (PARTITION BY s.ims_idx, s.mz, s.intensity, p.mz ORDER BY 1) AS k FROM spectra s JOIN peaklist p
  ON p.mz BETWEEN round(s.mz) - 0.5 AND round(s.mz) + 0.5 AND round(abs(s.mz - p.mz), 9) <= 0.02)
SELECT ims_idx, ref AS mz, round(max(intensity), 4) AS value FROM a GROUP BY ims_idx, ref""")
def align_and_bin_peaks(spark, sf_dir):
    from mosaica.operators.aggregates import bin_peaks

    return bin_peaks(joins.align_peaks(fixture(spark, sf_dir, "spectra"), fixture(spark, sf_dir, "peaklist"))).select("ims_idx", "mz", F.round("value", 4).alias("value"))


@query(with_sql("peaklist") + " SELECT arg_min(mz, abs(mz - 1023.4)) AS mz FROM peaklist")
def nearest_mz(spark, sf_dir):
    return joins.nearest_mz(fixture(spark, sf_dir, "peaklist"), 1023.4)


@query(with_sql("pixels") + """
SELECT a.sample_id, a.ims_idx, b.ims_idx AS neighbour, round(1.0 / count(*) OVER (PARTITION BY a.ims_idx), 6) AS w FROM pixels a JOIN pixels b
ON a.sample_id = b.sample_id AND abs(a.ims_x - b.ims_x) + abs(a.ims_y - b.ims_y) = 1""")
def lattice_neighbours(spark, sf_dir):
    return joins.lattice_neighbours(fixture(spark, sf_dir, "pixels"), style="W").select("sample_id", "ims_idx", "neighbour", *_r("w"))


@query(with_sql("pixels", "cell_annotation") + """
SELECT p.sample_id, p.ims_idx, c.cell_idx, c.celltype FROM cell_annotation c RIGHT JOIN pixels p ON c.sample_id = p.sample_id AND c.cell_idx = p.ims_idx""")
def join_pixels(spark, sf_dir):
    c = fixture(spark, sf_dir, "cell_annotation").withColumn("ims_idx", F.col("cell_idx"))
    return joins.join_pixels(c, fixture(spark, sf_dir, "pixels"), ["sample_id", "ims_idx"]).select("sample_id", "ims_idx", "cell_idx", "celltype")


@query(with_sql("pixels") + " SELECT sample_id, ims_idx FROM pixels")
def match_pixels_swapped(spark, sf_dir):
    px = fixture(spark, sf_dir, "pixels").select("sample_id", "ims_idx", F.col("ims_x").alias("x"), F.col("ims_y").alias("y"))
    return joins.match_pixels(px, px.select("sample_id", F.col("y").alias("x"), F.col("x").alias("y")), ["sample_id"]).select("sample_id", "ims_idx")


@query(with_sql("matches") + """
, m AS (SELECT sample, count(*) AS n, regr_slope(p2x, p1x) AS s FROM matches WHERE NOT is_error GROUP BY sample)
SELECT sample, n, CAST(1.01 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS c, CAST(1 AS DOUBLE) AS d, CAST(2 AS DOUBLE) AS tx, CAST(-1 AS DOUBLE) AS ty FROM m""")
def fit_affine(spark, sf_dir):
    fit = transforms.fit_affine(fixture(spark, sf_dir, "matches").where("not is_error"), ["sample"])
    plus = lambda c, k: (F.round(f"m.{c}", k) + 0.0).alias(c)
    return fit.select("sample", "n", *[plus(c, 6) for c in "abcd"], plus("tx", 4), plus("ty", 4))


@query(with_sql("matches") + " SELECT sample, count(*) AS n, CAST(sum(CASE WHEN is_error THEN 0 ELSE 1 END) AS INT) AS n_inliers FROM matches GROUP BY sample")
def fit_affine_robust(spark, sf_dir):
    return transforms.fit_affine_robust(fixture(spark, sf_dir, "matches"), ["sample"], 1.0, trials=24).select("sample", "n", "n_inliers")


@query(with_sql("matches") + """
, c AS (SELECT sample, p1x - avg(p1x) OVER w AS ax, p1y - avg(p1y) OVER w AS ay, p2x - avg(p2x) OVER w AS bx, p2y - avg(p2y) OVER w AS by_ FROM matches WHERE NOT is_error WINDOW w AS (PARTITION BY sample)),
s AS (SELECT sample, sum(ax * bx + ay * by_) AS dot, sum(ax * by_ - ay * bx) AS crs, sum(ax * ax + ay * ay) AS nrm FROM c GROUP BY sample)
SELECT sample, round(degrees(atan2(crs, dot)), 5) AS angle, round(sqrt(dot * dot + crs * crs) / nrm, 5) AS scale FROM s""")
def fit_rigid(spark, sf_dir):
    fit = transforms.fit_rigid(fixture(spark, sf_dir, "matches").where("not is_error"), ["sample"])
    return fit.select("sample", *[(F.round(c, 5) + 0.0).alias(c) for c in ("angle", "scale")])


@query(with_sql("points_a") + " SELECT id, round((SELECT max(y) FROM points_a) - y, 6) AS x, round(x, 6) AS y FROM points_a")
def rotate_coords(spark, sf_dir):
    return transforms.rotate_coords(fixture(spark, sf_dir, "points_a"), 90).select("id", *_r("x", "y"))


@query(with_sql("points_a") + ", g AS (SELECT id, x * 2 + 1 AS x, y * 2 - 3 AS y FROM points_a) SELECT id, round(0.5 * x, 6) AS x, round(0.5 * y, 6) AS y FROM g")
def compose_and_transform(spark, sf_dir):
    """Scale by two about the origin, shift, then halve: composed to one matrix for all points."""
    steps = spark.range(1).selectExpr(
        "inline(array(struct(0 seq, 'affine' kind, 2d a, 0d b, 0d c, 2d d, 0d tx, 0d ty, 0d cx, 0d cy), struct(1 seq, 'translation' kind, 9d a, 9d b, 9d c, 9d d, 1d tx, -3d ty, 5d cx, 5d cy), struct(2 seq, 'affine' kind, 0.5d a, 0d b, 0d c, 0.5d d, 0d tx, 0d ty, 0d cx, 0d cy)))"
    ).withColumn("core", F.lit("A"))
    m = transforms.compose_affine(steps, ["core"])
    return transforms.transform_points(fixture(spark, sf_dir, "points_a").withColumn("core", F.lit("A")), m, ["core"]).select("id", *_r("x", "y"))


@query(with_sql("boxes") + """
SELECT cell_idx, round(greatest(0, least(cx + half, 1000) - greatest(cx - half, 0)) * greatest(0, least(cy + half, 1000) - greatest(cy - half, 0)) / (4 * half * half) + 0.000000001, 6) AS share,
  cx > 0 AND cx < 1000 AND cy > 0 AND cy < 1000 AS inside FROM boxes""")
def clip_and_contain(spark, sf_dir):
    square = G.box_ring(F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(10.0))
    c = cells(spark, sf_dir).withColumn("c", G.ring_centroid(F.col("ring")))
    share = G.ring_area(G.clip_to_convex(F.col("ring"), square)) / G.ring_area(F.col("ring"))
    return c.select("cell_idx", F.round(share + 1e-9, 6).alias("share"), G.point_in_ring(F.round("c.x", 6), F.round("c.y", 6), square).alias("inside"))


@query(with_sql("pixels") + """
, g AS (SELECT sample_id, ims_x, ims_x - row_number() OVER (PARTITION BY sample_id, ims_y ORDER BY ims_x) AS run, ims_y FROM pixels)
SELECT sample_id, ims_y, min(ims_x) AS first, max(ims_x) AS last, count(*) AS n FROM g GROUP BY sample_id, ims_y, run""")
def pixel_runs(spark, sf_dir):
    """Runs of neighbouring pixels in a row: what component search joins instead of pixels."""
    runs = graphs.pixel_runs(fixture(spark, sf_dir, "pixels"), ["sample_id", "ims_y"], "ims_x")
    return runs.groupBy("sample_id", "ims_y", "run").agg(F.min("ims_x").alias("first"), F.max("ims_x").alias("last"), F.count("*").alias("n")).drop("run")


@query(with_sql("pixels").replace("WITH ", "WITH RECURSIVE ", 1) + """
, e AS MATERIALIZED (SELECT a.ims_idx AS a, b.ims_idx AS b FROM pixels a JOIN pixels b ON a.sample_id = b.sample_id AND abs(a.ims_x - b.ims_x) + abs(a.ims_y - b.ims_y) = 1),
r(id, root) AS (SELECT ims_idx, ims_idx FROM pixels UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id) SELECT id AS ims_idx, min(root) AS region FROM r GROUP BY id""")
def pixel_regions(spark, sf_dir):
    """Regions of pixels of a sample at distance 1 or less."""
    px = fixture(spark, sf_dir, "pixels").select("sample_id", "ims_idx", F.col("ims_x").cast("double").alias("x"), F.col("ims_y").cast("double").alias("y"))
    return graphs.pixel_regions(px, 1.0, ["sample_id"])


@query(with_sql("points_a", "points_b") + """
, d AS (SELECT a.id, b.id AS other, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d FROM points_a a JOIN points_b b ON abs(a.x - b.x) <= 1.3 AND abs(a.y - b.y) <= 1.3),
l AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, other) AS n FROM d WHERE d <= 1.3), r AS (SELECT *, row_number() OVER (PARTITION BY other ORDER BY d, id) AS k FROM l WHERE n = 1)
SELECT id, other, round(d, 6) AS d FROM r WHERE k = 1""")
def one_to_one(spark, sf_dir):
    return graphs.one_to_one(joins.radius_join(fixture(spark, sf_dir, "points_a"), fixture(spark, sf_dir, "points_b"), 1.3)).select("id", "other", *_r("d"))


_MERGE_ROUNDS = 12  # more than the tables need; a settled set stays as it is


@query(with_sql("points_a", "points_b") + """
, p0 AS (SELECT id, x, y FROM points_a UNION ALL SELECT id + 1000000, x, y FROM points_b)""" + "".join(f"""
, n{k} AS MATERIALIZED (SELECT a.id, arg_min(b.id, struct_pack(d := sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), i := b.id)) AS other FROM p{k} a JOIN p{k} b
  ON a.id <> b.id AND abs(a.x - b.x) < 0.5 AND abs(a.y - b.y) < 0.5 AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) < 0.5 GROUP BY a.id),
p{k + 1} AS MATERIALIZED (SELECT * FROM p{k} WHERE id NOT IN (SELECT greatest(id, other) FROM n{k}))""" for k in range(_MERGE_ROUNDS)) + f" SELECT id, round(x, 6) AS x, round(y, 6) AS y FROM p{_MERGE_ROUNDS}")
def merge_points(spark, sf_dir):
    a, b = fixture(spark, sf_dir, "points_a"), fixture(spark, sf_dir, "points_b").withColumn("id", F.col("id") + 1_000_000)
    return graphs.merge_points(a, b, 0.5).select("id", *_r("x", "y"))


@query(with_sql("matches") + """
, m AS (SELECT *, abs(p2x - p1x) AS d, count(*) OVER (PARTITION BY sample) AS n FROM matches)
SELECT id, round(p1x, 6) AS p1x, round(p1y, 6) AS p1y FROM m WHERE n < 5 OR NOT EXISTS (SELECT 1 FROM m b WHERE b.sample = m.sample AND b.p1y = m.p1y AND b.id <> m.id AND (b.d < m.d OR (b.d = m.d AND b.id < m.id)) AND (abs(b.p1x - m.p1x) < 1 OR abs(b.p2x - m.p2x) < 1))""")
def thin_matches(spark, sf_dir):
    """Matches of every sample, thinned within their sample. Rows of p1 and p2 are whole numbers here, so near ones share theirs, and one round settles all."""
    m = fixture(spark, sf_dir, "matches").withColumn("d", F.abs(F.col("p2x") - F.col("p1x")))
    return graphs.thin_matches(m, 1.0, keys=["sample"]).select("id", *_r("p1x", "p1y"))


@query(with_sql("boxes") + """
SELECT a.sample_id, a.cell_idx AS id, b.cell_idx AS other FROM boxes a JOIN boxes b ON a.sample_id = b.sample_id AND a.cell_idx < b.cell_idx
AND abs(a.cx - b.cx) <= 20 AND abs(a.cy - b.cy) <= 20 AND sqrt((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2) <= 20""")
def radius_self_join(spark, sf_dir):
    pts = fixture(spark, sf_dir, "boxes").select("sample_id", F.col("cell_idx").alias("id"), F.col("cx").alias("x"), F.col("cy").alias("y"))
    return joins.radius_self_join(pts, 20.0, ["sample_id"]).select("sample_id", "id", "other")


@query(with_sql("boxes", "cell_annotation") + """
, c AS (SELECT b.sample_id, b.cell_idx AS id, cx AS x, cy AS y, left(celltype, 1) AS t, CAST(floor(cx) AS INT) AS px FROM boxes b JOIN cell_annotation a ON a.sample_id = b.sample_id AND a.cell_idx = b.cell_idx),
k AS (SELECT a.sample_id, least(a.t, b.t) || ':' || greatest(a.t, b.t) AS pair, unnest([a.px, b.px]) AS ims_idx FROM c a JOIN c b ON a.sample_id = b.sample_id AND a.id < b.id AND abs(a.x - b.x) <= 20 AND abs(a.y - b.y) <= 20 AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 20),
w AS (SELECT sample_id, ims_idx, """ + ", ".join(f"sum(CASE WHEN pair = '{a}:{b}' THEN 1.0 ELSE 0 END) AS p{a}{b}" for a in range(1, 6) for b in range(a, 6)) + """ FROM k GROUP BY ALL)
SELECT p.sample_id, p.ims_idx, """ + ", ".join(f'CAST(coalesce(p{a}{b}, 0) AS DOUBLE) AS "{a}:{b}"' for a in range(1, 6) for b in range(a, 6)) + """ FROM (SELECT DISTINCT sample_id, px AS ims_idx FROM c) p LEFT JOIN w ON w.sample_id = p.sample_id AND w.ims_idx = p.ims_idx""")
def interaction_terms(spark, sf_dir):
    pts = fixture(spark, sf_dir, "boxes").join(joins.unbroadcast(fixture(spark, sf_dir, "cell_annotation")), ["sample_id", "cell_idx"])
    pts = pts.select("sample_id", F.col("cell_idx").alias("id"), F.col("cx").alias("x"), F.col("cy").alias("y"), F.substring("celltype", 1, 1).alias("celltype"), F.lit(1.0).alias("value"))
    at = pts.select("sample_id", "id", F.floor("x").cast("int").alias("ims_idx"))
    return graphs.interaction_terms(pts, at, ["1", "2", "3", "4", "5"], 20.0)
