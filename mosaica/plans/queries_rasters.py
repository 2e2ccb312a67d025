"""Queries for rasters and masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from mosaica.operators import aggregates as A
from mosaica.operators import graphs, rasters, windows
from mosaica.plans.fixtures import fixture, with_sql
from mosaica.plans.queries_tables import _r

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query(with_sql("labels_raster", "raster") + """
SELECT label, round(avg(CASE WHEN channel = 1 THEN value END), 4) AS c1, round(avg(CASE WHEN channel = 2 THEN value END), 4) AS c2
FROM labels_raster JOIN raster USING (row, col) WHERE label <> 0 GROUP BY label""")
def label_means(spark, sf_dir):
    out = A.label_means(fixture(spark, sf_dir, "labels_raster"), fixture(spark, sf_dir, "raster"), [1, 2])
    return out.select("label", F.round("1", 4).alias("c1"), F.round("2", 4).alias("c2"))


@query(with_sql("labels_raster") + """
SELECT label, count(*) AS area, round(avg(row), 6) AS c_row, round(avg(col), 6) AS c_col, min(row) AS r0, min(col) AS c0, max(row) AS r1, max(col) AS c1 FROM labels_raster WHERE label <> 0 GROUP BY label""")
def label_props(spark, sf_dir):
    return A.label_props(fixture(spark, sf_dir, "labels_raster")).select("label", "area", *_r("c_row", "c_col"), "r0", "c0", "r1", "c1")


@query(with_sql("labels_raster") + """
, n AS (SELECT a.label, b.label AS other, count(*) AS n FROM labels_raster a JOIN labels_raster b ON a.row = b.row AND a.col = b.col + 1 WHERE a.label <> 0 AND b.label <> 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, other) AS k FROM n) SELECT label, other, n FROM r WHERE k = 1""")
def majority_label(spark, sf_dir):
    a = fixture(spark, sf_dir, "labels_raster")
    return A.majority_label(a, a.withColumn("col", F.col("col") + 1))


_MASKS = with_sql("labels_raster") + ", a AS (SELECT row, col FROM labels_raster WHERE label % 2 = 0), b AS (SELECT row, col FROM labels_raster WHERE label % 3 = 0)"


def _masks(spark, sf_dir):
    px = fixture(spark, sf_dir, "labels_raster")
    return px.where("label % 2 = 0"), px.where("label % 3 = 0")


@query(_MASKS + " SELECT round(2 * (SELECT count(*) FROM a JOIN b USING (row, col)) / ((SELECT count(*) FROM a) + (SELECT count(*) FROM b)), 6) AS dice, round((SELECT count(*) FROM a JOIN b USING (row, col)) / (SELECT count(*) FROM a), 6) AS covered")
def mask_overlap(spark, sf_dir):
    a, b = _masks(spark, sf_dir)
    return A.dice(a, b).crossJoin(A.cover_fraction(a, b)).select(*_r("dice", "covered"))


@query(_MASKS + """
, g AS (SELECT DISTINCT row + i AS row, col + j AS col FROM a, (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j)),
n AS (SELECT a.row, a.col, count(*) AS n FROM a JOIN a x ON abs(a.row - x.row) <= 1 AND abs(a.col - x.col) <= 1 GROUP BY ALL)
SELECT (SELECT count(*) FROM g) AS dilated, (SELECT count(*) FROM n WHERE n = 9) AS eroded""")
def dilate_erode(spark, sf_dir):
    a = _masks(spark, sf_dir)[0].select("row", "col")
    return windows.dilate(a, 3).agg(F.count("*").alias("dilated")).crossJoin(windows.erode(a, 3).agg(F.count("*").alias("eroded")))


@query(with_sql("raster") + """
, p AS (SELECT x.value AS x, y.value AS y FROM raster x JOIN raster y ON x.row = y.row AND x.col = y.col AND x.channel = 1 AND y.channel = 2),
e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p),
c AS (SELECT least(floor((x - x0) / (x1 - x0) * 100), 99) AS i, least(floor((y - y0) / (y1 - y0) * 100), 99) AS j, count(*) / (SELECT count(*) FROM p) AS q FROM p, e GROUP BY ALL)
SELECT round((SELECT avg((x - y) ** 2) FROM p), 4) AS mse, round((SELECT sqrt(avg((x - y) ** 2)) / sqrt(avg(x * x)) FROM p), 6) AS nrmse,
round(((SELECT -sum(s * ln(s)) FROM (SELECT sum(q) AS s FROM c GROUP BY i)) + (SELECT -sum(s * ln(s)) FROM (SELECT sum(q) AS s FROM c GROUP BY j))) / (SELECT -sum(q * ln(q)) FROM c), 6) AS nmi""")
def image_similarity(spark, sf_dir):
    r = fixture(spark, sf_dir, "raster")
    return A.image_similarity(r.where("channel = 1"), r.where("channel = 2")).select(F.round("mse", 4).alias("mse"), *_r("nrmse", "nmi"))


@query(with_sql("raster") + """
, p AS (SELECT x.row, x.col, x.value AS x, y.value AS y FROM raster x JOIN raster y ON x.row = y.row AND x.col = y.col AND x.channel = 1 AND y.channel = 2),
w AS (SELECT a.row, a.col, avg(b.x) AS mx, avg(b.y) AS my, var_samp(b.x) AS vx, var_samp(b.y) AS vy, covar_samp(b.x, b.y) AS vxy FROM p a JOIN p b ON b.row BETWEEN a.row - 3 AND a.row + 3 AND b.col BETWEEN a.col - 3 AND a.col + 3 GROUP BY ALL HAVING count(*) = 49)
SELECT round(avg((2 * mx * my + 100) * (2 * vxy + 900) / ((mx * mx + my * my + 100) * (vx + vy + 900))), 6) AS ssim FROM w""")
def ssim(spark, sf_dir):
    r = fixture(spark, sf_dir, "raster")
    return windows.ssim(r.where("channel = 1"), r.where("channel = 2"), 1000.0).select(*_r("ssim"))


@query(with_sql("raster") + " SELECT CAST(row AS INT) AS row, CAST(col AS INT) AS col, round(value, 4) AS value FROM raster WHERE channel = 1 AND value <> 0")
def resample_shift(spark, sf_dir):
    """The shift over the raster's whole extent."""
    r = fixture(spark, sf_dir, "raster").where("channel = 1")
    e = r.agg(*[F.coalesce(f(c), F.lit(0)) for c in ("row", "col") for f in (F.min, F.max)]).first()  # one row
    moved = rasters.resample(r, (1, 0, 0, 1, 2, 1), (e[0] - 1, e[1]), (e[2] - 2, e[3] - 1))
    return moved.where("value <> 0").select((F.col("row") + 1).alias("row"), (F.col("col") + 2).alias("col"), F.round("value", 4).alias("value"))


@query(with_sql("raster") + " SELECT l AS level, CAST(row / power(2, l) AS INT) AS row, CAST(col / power(2, l) AS INT) AS col, round(value, 4) AS value FROM raster, (SELECT unnest([0, 1, 2]) AS l) WHERE channel = 1 AND row % power(2, l) = 0 AND col % power(2, l) = 0")
def pyramid(spark, sf_dir):
    return rasters.pyramid(fixture(spark, sf_dir, "raster").where("channel = 1").drop("channel"), 3).select("level", "row", "col", F.round("value", 4).alias("value"))


@query(_MASKS.replace("WITH ", "WITH RECURSIVE ", 1) + """
, e AS MATERIALIZED (SELECT x.row AS r, x.col AS c, y.row AS r2, y.col AS c2 FROM a x JOIN a y ON abs(x.row - y.row) + abs(x.col - y.col) = 1),
k(row, col, root) AS (SELECT row, col, CAST(row AS BIGINT) * 4294967296 + col FROM a UNION SELECT e.r2, e.c2, k.root FROM k JOIN e ON e.r = k.row AND e.c = k.col) SELECT row, col, min(root) AS component FROM k GROUP BY ALL""")
def pixel_components(spark, sf_dir):
    return graphs.pixel_components(_masks(spark, sf_dir)[0])


@query(with_sql("labels_raster").replace("WITH ", "WITH RECURSIVE ", 1) + """
, px AS MATERIALIZED (SELECT CAST(floor(col / 25) AS INT) AS image_id, row, col, CAST(1 + floor(row / 3) * 9 + floor(col % 25 / 3) AS INT) AS label FROM labels_raster WHERE label <> 0),
r(image_id, label, row, col, root) AS (SELECT image_id, label, row, col, row * 1000000 + col FROM px UNION SELECT p.image_id, p.label, p.row, p.col, r.root FROM r JOIN px p ON p.image_id = r.image_id AND p.label = r.label AND abs(p.row - r.row) + abs(p.col - r.col) = 1),
parts AS (SELECT image_id, label, count(DISTINCT low) AS parts FROM (SELECT image_id, label, row, col, min(root) AS low FROM r GROUP BY ALL) GROUP BY ALL),
v AS (SELECT image_id, label, row + i AS vr, col + j AS vc, count(*) AS n, sum(2 * i + j) AS s FROM px, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j) GROUP BY ALL),
k AS (SELECT image_id, label, sum(CASE WHEN n = 1 OR n = 3 THEN 1 WHEN n = 2 AND s = 3 THEN 2 ELSE 0 END) AS corners, sum(CASE WHEN n = 1 THEN 1 WHEN n = 3 THEN -1 WHEN n = 2 AND s = 3 THEN 2 ELSE 0 END) AS euler FROM v GROUP BY ALL)
SELECT image_id, label, CAST(corners + 1 AS INT) AS points FROM k JOIN parts USING (image_id, label) WHERE euler = 4 AND parts = 1""")
def labels_to_polygons(spark, sf_dir):
    """Blocks of three by three pixels with holes where the part is large; the SQL counts the corners of their outlines."""
    block = (1 + F.floor(F.col("row") / 3) * 9 + F.floor(F.col("col") % 25 / 3)).cast("int")
    px = fixture(spark, sf_dir, "labels_raster").select(F.floor(F.col("col") / 25).cast("int").alias("image_id"), "row", "col", F.when(F.col("label") != 0, block).otherwise(0).alias("label"))
    return rasters.labels_to_polygons(px).select("image_id", "label", F.size("ring").alias("points"))


@query(with_sql("labels_raster") + """
, m AS (SELECT label, avg(col) AS cx, avg(row) AS cy, count(*) AS n FROM labels_raster WHERE label <> 0 GROUP BY label)
SELECT l.label AS id, n AS area, round(sum((col - cx) ** 2 + (row - cy) ** 2) / (CAST(n AS DOUBLE) * n), 3) AS hu1 FROM labels_raster l JOIN m USING (label) GROUP BY l.label, n""")
def region_moments(spark, sf_dir):
    px = fixture(spark, sf_dir, "labels_raster").where("label <> 0").withColumnRenamed("label", "id")
    return rasters.region_moments(px).select("id", F.col("area").cast("long").alias("area"), *_r("hu1", digits=3))


@query(with_sql("pixels") + """
, n AS (SELECT a.ims_idx, count(*) AS n FROM pixels a JOIN pixels b ON a.sample_id = b.sample_id AND abs(a.ims_x - b.ims_x) + abs(a.ims_y - b.ims_y) = 1 GROUP BY 1)
SELECT sample_id, ims_idx FROM pixels LEFT JOIN n USING (ims_idx) WHERE coalesce(n, 0) < 4""")
def lattice_boundary(spark, sf_dir):
    return rasters.lattice_boundary(fixture(spark, sf_dir, "pixels")).select("sample_id", "ims_idx")
