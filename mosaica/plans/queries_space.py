"""Queries for geometry, rasters, transforms and point sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from mosaica.functions import geometry as G
from mosaica.operators import aggregates as A
from mosaica.operators import graphs, joins, rasters, transforms, verdicts, windows
from mosaica.plans.fixtures import cells, fixture, with_sql
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


def _rows(spark, *rows: str):
    """A parameter table of struct literals."""
    return spark.range(1).selectExpr(f"inline(array({', '.join(f'struct({r})' for r in rows)}))")


# ---- rings ----


@query(with_sql("boxes") + """
SELECT cell_idx, round(greatest((cx - half) / 100 - 0.5, 0), 6) AS x0, round(least((cy + half) / 100 + 0.5, 19), 6) AS y1, (cx - half) / 100 >= 0 AND (cy - half) / 100 >= 0 AND (cx + half) / 100 <= 24 AND (cy + half) / 100 <= 19 AS in_range,
  round(2 * (cx + half) / 100 + 1, 6) AS moved_x, round(least((cx - half) / 100, cx / 100 - 0.4, (cx - half) / 100 - 0.1), 6) AS e0x, round(greatest((cy + half) / 100, cy / 100 + 0.4), 6) AS e1y,
  CASE WHEN half > 27 THEN 0 END AS quad, 1 AS corners FROM boxes""")
def ring_functions(spark, sf_dir):
    c = cells(spark, sf_dir)
    box = G.ring_bbox(F.col("ring"), 0.5, 24, 19)
    moved = transforms.transform_rings(c.withColumn("core", F.lit("A")), _rows(spark, "'A' core, named_struct('a', 2d, 'b', 0d, 'c', 0d, 'd', 2d, 'tx', 1d, 'ty', 0d) m"), ["core"])
    b = c.select("cell_idx", "sample_id", G.ring_bbox(F.col("ring")).alias("b")).select("cell_idx", "sample_id", "b.*").withColumns({"m0x": F.col("x0") - 0.1, "m0y": F.lit(None).cast("double"), "m1x": F.lit(None).cast("double"), "m1y": F.lit(None).cast("double")})
    grown = transforms.expand_core_box(b, 0.8).select("sample_id", "cell_idx", *_r("e0x", "e1y"))
    corners = F.array_distinct(F.transform(G.corner_labels(F.col("ring")), lambda p: p.corner))
    wide = G.ring_area(F.col("ring")) > 0.29
    out = transforms.check_ring(c, 24.0, 19.0).select(
        "sample_id", "cell_idx", F.round(box.x0, 6).alias("x0"), F.round(box.y1, 6).alias("y1"), "in_range",
        F.when(wide, F.round(G.quad_rotation(F.col("ring")), 6).cast("int")).alias("quad"), (F.size(corners) == 4).cast("int").alias("corners"),
    )
    out = out.join(grown, ["sample_id", "cell_idx"]).join(moved.select("sample_id", "cell_idx", F.round(F.array_max(F.transform("ring", lambda p: p.x)), 6).alias("moved_x")), ["sample_id", "cell_idx"])
    return out.select("cell_idx", "x0", "y1", "in_range", "moved_x", "e0x", "e1y", "quad", "corners")


@query(with_sql("boxes") + """
, i AS (SELECT cell_idx, cx, cy, half, greatest(0, least(cx + half, 1000) - greatest(cx - half, 0)) * greatest(0, least(cy + half, 1000) - greatest(cy - half, 0)) AS w FROM boxes),
d AS (SELECT *, CASE WHEN cx > 0 AND cx < 1000 AND cy > 0 AND cy < 1000 THEN least(cx, 1000 - cx, cy, 1000 - cy) END AS edge FROM i)
SELECT cell_idx, round(2 * w / (4 * half * half + 1000000), 6) AS dice, coalesce(edge <= 150, false) AS near_edge, cx >= 0 AND cx <= 1000 AND cy >= 0 AND cy <= 1000 AS in_convex FROM d""")
def ring_relations(spark, sf_dir):
    square = G.box_ring(F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(10.0))
    b = fixture(spark, sf_dir, "boxes").select("cell_idx", "sample_id", (F.col("cx") / 100).alias("x"), (F.col("cy") / 100).alias("y"))
    c = cells(spark, sf_dir).join(b, ["sample_id", "cell_idx"])
    return c.select("cell_idx", F.round(G.polygon_dice(F.col("ring"), square), 6).alias("dice"), G.near_edge(F.col("x"), F.col("y"), square, 1.5).alias("near_edge"), G.in_convex(F.col("x"), F.col("y"), square).alias("in_convex"))


@query(with_sql("boxes") + """
, i AS (SELECT sample_id || '-' || cell_idx AS name, cx, cy, half FROM boxes), o AS (SELECT DISTINCT 'Q' || CAST(floor(cx / 500) AS INT) || '-' || CAST(floor(cy / 500) AS INT) AS name, floor(cx / 500) * 500 AS x0, floor(cy / 500) * 500 AS y0 FROM boxes),
s AS (SELECT i.name, o.name AS o, greatest(0, least(cx + half, x0 + 500) - greatest(cx - half, x0)) * greatest(0, least(cy + half, y0 + 500) - greatest(cy - half, y0)) / (4 * half * half) AS share FROM i JOIN o ON cx - half <= x0 + 500 AND cx + half >= x0 AND cy - half <= y0 + 500 AND cy + half >= y0),
n AS (SELECT name, count(*) AS n, min(o) AS o FROM s WHERE share >= 0.45 - 1e-12 GROUP BY name)
SELECT i.name, CASE WHEN n = 1 THEN o END AS outer_name, coalesce(n, 0) AS n_found FROM i LEFT JOIN n USING (name)""")
def match_locations(spark, sf_dir):
    """Cells against squares of five units; a share of 0.45 lets a cell on an edge meet two."""
    inner = cells(spark, sf_dir).select(F.concat_ws("-", "sample_id", "cell_idx").alias("name"), "ring")
    x, y = F.floor(F.col("cx") / 500).cast("int"), F.floor(F.col("cy") / 500).cast("int")
    outer = fixture(spark, sf_dir, "boxes").select(F.concat(F.lit("Q"), x, F.lit("-"), y).alias("name"), x.alias("qx"), y.alias("qy")).distinct()
    outer = outer.select("name", G.box_ring(F.col("qx") * 5.0, F.col("qy") * 5.0, F.col("qx") * 5.0 + 5, F.col("qy") * 5.0 + 5).alias("ring"))
    return joins.match_locations(inner, outer, 0.45 - 1e-12, 5.0)


@query(with_sql("boxes") + """
, s AS (SELECT cell_idx AS id, cx * 2 / 100 AS x, cy * 2 / 100 AS y, half * 2 / 100 AS h FROM boxes WHERE sample_id = 'S1')
SELECT id, CAST(r AS INT) AS row, CAST(c AS INT) AS col FROM s, LATERAL (SELECT unnest(range(CAST(floor(y - h) AS INT), CAST(ceil(y + h) AS INT) + 1)) AS r), LATERAL (SELECT unnest(range(CAST(floor(x - h) AS INT), CAST(ceil(x + h) AS INT) + 1)) AS c) WHERE r > y - h + 1e-9 AND r < y + h - 1e-9 AND c > x - h + 1e-9 AND c < x + h - 1e-9""")
def rasterise(spark, sf_dir):
    """Cells of the sample chosen by name, in half units, as pixels."""
    c = cells(spark, sf_dir).select(F.col("cell_idx").alias("id"), F.col("sample_id").alias("name"), F.transform("ring", lambda p: G.point(F.round(p.x, 4), F.round(p.y, 4))).alias("ring"))
    return rasters.rasterise(transforms.select_location(c, "S1", 2.0))


# ---- rasters ----


@query(with_sql("labels_raster") + """
SELECT CAST(r AS INT) AS row, CAST(c AS INT) AS col, label FROM labels_raster, LATERAL (SELECT unnest(range(CAST(ceil(row * 1.5) AS INT), CAST(ceil((row + 1) * 1.5) AS INT))) AS r), LATERAL (SELECT unnest(range(CAST(ceil(col * 1.5) AS INT), CAST(ceil((col + 1) * 1.5) AS INT))) AS c)""")
def rescale_labels(spark, sf_dir):
    return rasters.rescale_labels(fixture(spark, sf_dir, "labels_raster"), 1.5)


@query(with_sql("labels_raster") + """
, b AS (SELECT label AS id, min(row) AS r0, min(col) AS c0, max(row) AS r1, max(col) AS c1 FROM labels_raster WHERE label > 0 GROUP BY label),
c AS (SELECT id, list(DISTINCT coalesce(l.label, 0)) AS s FROM (SELECT id, unnest([r0, r0, r1, r1]) AS row, unnest([c0, c1, c0, c1]) AS col FROM b) LEFT JOIN labels_raster l USING (row, col) GROUP BY id)
SELECT c.id, CASE WHEN len(s) = 1 AND s[1] <> 0 THEN s[1] END AS label, greatest(r0 - 2, 0) AS r0, least(c1 + 2, 30) AS c1 FROM c JOIN b USING (id)""")
def corner_label(spark, sf_dir):
    px = fixture(spark, sf_dir, "labels_raster")
    b = A.label_props(px).select(F.col("label").alias("id"), "r0", "c0", "r1", "c1")
    u = A.union_bbox(b, 2.0, (1e9, 30.0), ["id"])
    return A.corner_label(b, px).join(u, "id").select("id", "label", F.col("r0").cast("int").alias("r0"), F.col("c1").cast("int").alias("c1"))


@query(with_sql("pixels") + """
, b AS (SELECT sample_id, min(ims_x) AS x0, max(ims_x) AS x1, min(ims_y) AS y0, max(ims_y) AS y1 FROM pixels GROUP BY 1),
g AS (SELECT sample_id, x0, y0, unnest(range(y1 - y0 + 1)) AS row, x1 - x0 AS w FROM b), h AS (SELECT sample_id, x0, y0, row, unnest(range(w + 1)) AS col FROM g)
SELECT h.sample_id, CAST(row AS INT) AS row, CAST(col AS INT) AS col, coalesce(CAST(p.ims_idx AS DOUBLE), 0) AS value FROM h LEFT JOIN pixels p ON p.sample_id = h.sample_id AND p.ims_x = x0 + col AND p.ims_y = y0 + row""")
def points_to_grid(spark, sf_dir):
    px = fixture(spark, sf_dir, "pixels").select("sample_id", "ims_idx", F.col("ims_x").alias("x"), F.col("ims_y").alias("y"))
    return rasters.points_to_grid(rasters.index_slice(px).select("sample_id", "x", "y", "value"))


@query(with_sql("pixels") + """
, o AS (SELECT sample_id, ims_idx, ims_x - min(ims_x) OVER w AS x, ims_y - min(ims_y) OVER w AS y FROM pixels WINDOW w AS (PARTITION BY sample_id)) SELECT sample_id, ims_idx, x, y, CASE WHEN y % 2 <> x % 2 THEN 2.0 ELSE 1.0 END AS value FROM o""")
def checker_slice(spark, sf_dir):
    px = fixture(spark, sf_dir, "pixels").select("sample_id", "ims_idx", (F.col("ims_x") + 7).alias("x"), (F.col("ims_y") + 3).alias("y"))
    return rasters.checker_slice(windows.normalise_origin(px).withColumns({"row": F.col("y"), "col": F.col("x")})).drop("row", "col")


@query(with_sql("grid_pixels") + """
, w AS (SELECT ims_idx AS seq, row * 2 + i AS row, col * 2 + j AS col FROM grid_pixels, (SELECT unnest([-2, -1, 0, 1, 2]) AS i), (SELECT unnest([-2, -1, 0, 1, 2]) AS j)) SELECT CAST(row AS INT) AS row, CAST(col AS INT) AS col, max(seq) AS value FROM w GROUP BY ALL""")
def footprint(spark, sf_dir):
    g = fixture(spark, sf_dir, "grid_pixels").select(F.col("ims_idx").alias("seq"), (F.col("row") * 2).alias("row"), (F.col("col") * 2).alias("col"), F.col("ims_idx").alias("value"))
    return rasters.footprint(g, 4)


@query(with_sql("grid_pixels") + """
, e AS (SELECT min(col) AS x0, max(col) AS x1, min(row) AS y0, max(row) AS y1 FROM grid_pixels), c AS (SELECT 2 * x + 1 AS x, 3 * y - 4 AS y FROM (SELECT unnest([x0, x0, x1, x1]) AS x, unnest([y0, y1, y0, y1]) AS y FROM e))
SELECT CAST(greatest(min(x) - 1, 0) AS INT) AS c0, CAST(least(max(x) + 1, 100000) AS INT) AS c1, CAST(greatest(min(y) - 1, 0) AS INT) AS r0, CAST(least(max(y) + 1, 50) AS INT) AS r1 FROM c""")
def target_bbox(spark, sf_dir):
    g = fixture(spark, sf_dir, "grid_pixels").select(F.col("col").alias("x"), F.col("row").alias("y"))
    return rasters.target_bbox(g, (2, 0, 0, 3, 1, -4), (50, 100000)).select(*[F.col(c).cast("int").alias(c) for c in ("c0", "c1", "r0", "r1")])


@query(with_sql("labels_raster") + """
, p AS (SELECT label AS id, row, col FROM labels_raster WHERE label > 0 UNION ALL SELECT label + 100, row, col FROM labels_raster WHERE label > 0 AND NOT (row = 0 AND label % 2 = 0) UNION ALL SELECT label + 200, row + 1, col FROM labels_raster WHERE label > 0),
n AS (SELECT id, count(*) AS n FROM p GROUP BY id), l AS (SELECT a.id, b.id AS other FROM (SELECT a.id, b.id AS o, count(*) AS m FROM p a JOIN p b USING (row, col) WHERE a.id < b.id GROUP BY ALL) x JOIN n a ON a.id = x.id JOIN n b ON b.id = x.o WHERE 2 * m / (a.n + b.n) > 0.98),
g AS (SELECT n.id, n.n, least(n.id, coalesce(min(l.id), n.id)) AS g FROM n LEFT JOIN l ON l.other = n.id GROUP BY n.id, n.n)
SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY g ORDER BY n DESC, id) AS k FROM g) WHERE k = 1""")
def dedupe_regions(spark, sf_dir):
    px = fixture(spark, sf_dir, "labels_raster").where("label > 0").select(F.col("label").alias("id"), "row", "col")
    near = px.where("not (row = 0 and id % 2 = 0)").withColumn("id", F.col("id") + 100)
    return rasters.dedupe_regions(px.unionByName(near).unionByName(px.withColumns({"id": F.col("id") + 200, "row": F.col("row") + 1})))


@query(with_sql("labels_raster") + """
, m AS (SELECT row, col FROM labels_raster WHERE label % 5 = 1), b AS (SELECT row, col FROM labels_raster WHERE label % 5 <> 1),
d AS (SELECT b.row, b.col, min(sqrt((b.row - m.row) ** 2 + (b.col - m.col) ** 2)) AS d FROM b JOIN m ON abs(b.row - m.row) <= 3 AND abs(b.col - m.col) <= 3 GROUP BY ALL HAVING min(sqrt((b.row - m.row) ** 2 + (b.col - m.col) ** 2)) <= 3)
SELECT count(*) AS n, round(avg(d), 6) AS mean, round(max(d), 6) AS max, round(quantile_cont(d, 0.75), 6) AS q75 FROM d""")
def background_distance(spark, sf_dir):
    px = fixture(spark, sf_dir, "labels_raster").withColumn("label", F.when(F.col("label") % 5 == 1, F.col("label")).otherwise(0))
    return rasters.background_distance(px, 3.0).select("n", *_r("mean", "max", "q75"))


@query(with_sql("labels_raster") + """
, p AS (SELECT label AS id, row, col FROM labels_raster WHERE label > 0), q AS (SELECT CASE WHEN label % 2 = 0 THEN label ELSE 200 - label END AS id, row, col FROM labels_raster WHERE label > 0 AND (row + label) % 4 <> 0),
n1 AS (SELECT id, count(*) AS n FROM p GROUP BY 1), n2 AS (SELECT id, count(*) AS n FROM q GROUP BY 1), m AS (SELECT p.id, q.id AS other, count(*) AS m FROM p JOIN q USING (row, col) GROUP BY ALL)
SELECT m.id, m.other, round(2 * m / (n1.n + n2.n), 6) AS dice FROM m JOIN n1 ON n1.id = m.id JOIN n2 ON n2.id = m.other""")
def max_dice(spark, sf_dir):
    """Each label meets one label of the other set here, so the best is the only one."""
    p = fixture(spark, sf_dir, "labels_raster").where("label > 0").select(F.col("label").alias("id"), "row", "col")
    q = p.where("(row + id) % 4 <> 0").withColumn("id", F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(200 - F.col("id")))
    return A.max_dice(p, q).select("id", "other", *_r("dice"))


@query(with_sql("labels_raster") + """
, a AS (SELECT row, col FROM labels_raster WHERE label % 2 = 0), b AS (SELECT row, col FROM labels_raster WHERE label % 3 = 0), i AS (SELECT count(*) AS n FROM a JOIN b USING (row, col)),
x AS (SELECT count(*) AS n, avg(row) AS r, avg(col) AS c FROM a), y AS (SELECT count(*) AS n, avg(row) AS r, avg(col) AS c FROM b)
SELECT round(2 * i.n / (x.n + y.n), 6) AS dice, round(x.n / 4, 6) AS area1, round(y.n / 4, 6) AS area2, round(sqrt((x.r - y.r) ** 2 + (x.c - y.c) ** 2), 6) AS centroid_distance FROM i, x, y""")
def mask_metrics(spark, sf_dir):
    px = fixture(spark, sf_dir, "labels_raster")
    return verdicts.mask_metrics(px.where("label % 2 = 0"), px.where("label % 3 = 0"), 2.0).select(*_r("dice", "area1", "area2", "centroid_distance"))


_SSIM = """
, p AS (SELECT x.row, x.col, x.value AS x, y.value AS y FROM raster x JOIN raster y ON x.row = y.row AND x.col = y.col AND x.channel = 1 AND y.channel = 2),
w AS (SELECT a.row, a.col, count(*) AS n, avg(b.x) AS mx, avg(b.y) AS my, var_samp(b.x) AS vx, var_samp(b.y) AS vy, covar_samp(b.x, b.y) AS vxy FROM p a JOIN p b ON b.row BETWEEN a.row - 3 AND a.row + 3 AND b.col BETWEEN a.col - 3 AND a.col + 3 GROUP BY ALL HAVING count(*) = 49),
z AS (SELECT avg((2 * mx * my + 100) * (2 * vxy + 900) / ((mx * mx + my * my + 100) * (vx + vy + 900))) AS ssim FROM w)"""


@query(with_sql("raster") + _SSIM + ", e AS (SELECT avg((x - y) ** 2) AS mse FROM p) SELECT round(mse, 4) AS mse, round(ssim, 6) AS ssim FROM e, z")
def similarity_metrics(spark, sf_dir):
    r = fixture(spark, sf_dir, "raster")
    return verdicts.similarity_metrics(r.where("channel = 1"), r.where("channel = 2"), 1000.0).select(F.round("mse", 4).alias("mse"), *_r("ssim"))


@query(with_sql("grid_pixels", "labels_raster") + """
, s AS (SELECT max(row) + 1 AS h, max(col) + 1 AS w FROM grid_pixels), g AS (SELECT r, c FROM s, LATERAL (SELECT unnest(range(0, h, 5)) AS r), LATERAL (SELECT unnest(range(0, w, 5)) AS c)),
d AS (SELECT sqrt((0.1 * c + 0.02 * r + 3) ** 2 + (-0.01 * c + 0.05 * r - 1) ** 2) AS d FROM g), t AS (SELECT row, col FROM labels_raster WHERE label > 20), a AS (SELECT row, col FROM labels_raster WHERE label % 2 = 0), b AS (SELECT row, col FROM labels_raster WHERE label % 3 = 0)
SELECT (SELECT count(*) FROM d) AS n, (SELECT round(avg(d), 6) FROM d) AS mean, (SELECT round(max(d), 6) FROM d) AS max, (SELECT round(quantile_cont(d, 0.5), 6) FROM d) AS q50,
round((SELECT count(*) FROM t JOIN a USING (row, col)) / (SELECT count(*) FROM t), 6) AS covered_before, round((SELECT count(*) FROM t JOIN b USING (row, col)) / (SELECT count(*) FROM t), 6) AS covered_after""")
def frame_metrics(spark, sf_dir):
    """Displacement of control points over the raster's extent, and the share of a mask that two others cover."""
    shape = fixture(spark, sf_dir, "grid_pixels").agg(F.max("row") + 1, F.max("col") + 1).first()  # one row
    px = fixture(spark, sf_dir, "labels_raster")
    d = rasters.grid_displacement(spark, (shape[0] or 1, shape[1] or 1), (1.1, 0.02, -0.01, 1.05, 3, -1), 5)
    return verdicts.frame_metrics(d, px.where("label % 2 = 0"), px.where("label % 3 = 0"), px.where("label > 20")).select("n", *_r("mean", "max", "q50", "covered_before", "covered_after"))


# ---- transforms and matches ----


@query(with_sql("matches") + """
, s AS (SELECT sample, 'affine' AS kind, 0 AS seq FROM matches UNION SELECT DISTINCT sample, CASE WHEN sample % 2 = 0 THEN 'BSpline' ELSE 'affine' END, 1 FROM matches UNION SELECT DISTINCT sample, CASE WHEN sample % 3 = 0 THEN 'BSpline' ELSE 'translation' END, 2 FROM matches)
SELECT sample, bool_and(kind <> 'BSpline') AS linear, (SELECT bool_or(kind <> 'BSpline') FROM s t WHERE t.sample = s.sample AND seq >= 1) AS some FROM s WHERE seq < 2 GROUP BY sample""")
def is_linear(spark, sf_dir):
    n = fixture(spark, sf_dir, "matches").select("sample").distinct()
    kinds = F.array(F.lit("affine"), F.when(F.col("sample") % 2 == 0, "BSpline").otherwise("affine"), F.when(F.col("sample") % 3 == 0, "BSpline").otherwise("translation"))
    steps = n.select("sample", F.posexplode(kinds).alias("seq", "kind"))
    layers = ["postIMS", "preIMS", "preIMC", "postIMC"]
    first = transforms.is_linear(transforms.chain_slice(steps, "postIMS", "preIMC", layers), ["sample"])
    some = transforms.is_linear(transforms.chain_slice(steps, "preIMS", "postIMC", layers), ["sample"], any_linear=True).withColumnRenamed("linear", "some")
    return first.join(some, "sample")


@query(with_sql("matches") + """
SELECT id, round(CASE WHEN is_error THEN 50 ELSE 0 END, 4) AS residual, NOT is_error AS inlier, 1.01 AS affine_a, CAST(2 AS DOUBLE) AS global_x_shift FROM matches""")
def score_inliers(spark, sf_dir):
    m = fixture(spark, sf_dir, "matches")
    fit = transforms.fit_affine(m.where("not is_error"), ["sample"])
    scored = transforms.score_inliers(m, fit, ["sample"], 1.0).join(transforms.affine_metrics(fit, ["sample"]), "sample")
    return scored.select("id", (F.round("residual", 4) + 0.0).alias("residual"), "inlier", F.round("affine_a", 5).alias("affine_a"), F.round("global_x_shift", 3).alias("global_x_shift"))


@query(with_sql("matches") + """
, m AS (SELECT * FROM matches WHERE NOT is_error) SELECT sample, round(least(avg(sqrt((1.01 * p1x + 2 - p2x - 0.5) ** 2)), 1e9), 4) AS error FROM m GROUP BY sample""")
def landmark_error(spark, sf_dir):
    """Landmarks half a unit off under the matrix, stored transposed and in the other direction."""
    m = fixture(spark, sf_dir, "matches").where("not is_error")
    stored = transforms.matrix({"a": F.lit(1 / 1.01), "b": F.lit(0.0), "c": F.lit(0.0), "d": F.lit(1.0), "tx": F.lit(-2 / 1.01), "ty": F.lit(1.0)})
    off = m.withColumn("p2x", F.col("p2x") + 0.5).withColumn("m", stored)
    return transforms.landmark_error(off, ["sample"]).select("sample", F.when(F.col("error") < 0.5, F.round(F.col("error") * 1.01, 4)).otherwise(F.round("error", 4)).alias("error"))


@query(with_sql("matches") + """
, o AS (SELECT sample, count(*) AS n, sum(CASE WHEN is_error THEN 0 ELSE 1 END) AS k, avg(CASE WHEN NOT is_error THEN sqrt((p1x - p2x) ** 2 + 1) END) AS mean, max(CASE WHEN NOT is_error THEN sqrt((p1x - p2x) ** 2 + 1) END) AS top FROM matches GROUP BY sample)
SELECT sample, n AS n_matches, CAST(k AS INT) AS n_inliers, round(mean, 5) AS mean, round(top, 5) AS max, CAST(2 AS DOUBLE) AS global_x_shift FROM o""")
def landmark_metrics(spark, sf_dir):
    m = fixture(spark, sf_dir, "matches").withColumn("on_tissue", F.lit(True))
    return verdicts.landmark_metrics(m, ["sample"], 1.0).select("sample", "n_matches", "n_inliers", *_r("mean", "max", digits=5), F.round("global_x_shift", 3).alias("global_x_shift"))


@query(with_sql("matches") + """
, p AS (SELECT sample, abs(p2x - p1x) AS d, (id % 11) / 10.0 AS dice FROM matches) SELECT sample, count(*) AS n, round(avg(d), 6) AS mean, round(quantile_cont(d, 0.25), 6) AS q25, round(avg(dice), 6) AS dice_mean, round(quantile_cont(dice, 0.5), 6) AS dice_q50 FROM p WHERE dice > 0 GROUP BY sample""")
def region_metrics(spark, sf_dir):
    p = fixture(spark, sf_dir, "matches").select("sample", F.abs(F.col("p2x") - F.col("p1x")).alias("d"), ((F.col("id") % 11) / 10).alias("dice"))
    return verdicts.region_metrics(p, ["sample"]).select("sample", "n", *_r("mean", "q25", "dice_mean", "dice_q50"))


@query(with_sql("points_a", "points_b") + """
, d AS (SELECT a.id, b.id AS other, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d FROM points_a a JOIN points_b b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1),
r AS (SELECT id, min(d) AS d, id % 3 <> 0 AS ok FROM d WHERE d <= 1 GROUP BY id), k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, other) AS ra, row_number() OVER (PARTITION BY other ORDER BY d, id) AS rb FROM d WHERE d <= 0.4)
SELECT count(d) AS n, round(avg(d), 6) AS mean, count(CASE WHEN ok THEN d END) AS masked_n, round(quantile_cont(CASE WHEN ok THEN d END, 0.5), 6) AS masked_q50, (SELECT count(*) FROM points_a) AS n_total,
(SELECT round(avg(d), 6) FROM k WHERE ra = 1 AND rb = 1 AND d < 0.4) AS mean_error, (SELECT count(*) FROM k WHERE ra = 1 AND rb = 1 AND d < 0.4) AS accepted FROM r""")
def mark_metrics(spark, sf_dir):
    marks = fixture(spark, sf_dir, "points_a").withColumn("in_mask", F.col("id") % 3 != 0)
    px = fixture(spark, sf_dir, "points_b")
    ok = verdicts.accepted_marks(marks, px, 0.8).withColumnRenamed("n", "accepted")
    return verdicts.mark_metrics(marks, px, 1.0).crossJoin(ok).select("n", *_r("mean"), "masked_n", *_r("masked_q50"), "n_total", *_r("mean_error"), "accepted")  # one row each


@query(with_sql("points_a", "points_b") + """
, g AS (SELECT dx, dy FROM (SELECT unnest([0.0, 0.3]) AS dx), (SELECT unnest([-0.2, 0.1]) AS dy)),
d AS (SELECT dx, dy, a.id, min(sqrt((a.x + dx - b.x) ** 2 + (a.y + dy - b.y) ** 2)) AS d FROM g, points_a a JOIN points_b b ON abs(a.x - b.x) <= 2.5 AND abs(a.y - b.y) <= 2.5 GROUP BY ALL)
SELECT CAST(dx AS DOUBLE) AS dx, CAST(dy AS DOUBLE) AS dy, round(max(d), 6) AS worst FROM d GROUP BY ALL""")
def score_shifts(spark, sf_dir):
    grid = joins.param_grid(spark, dx=[0.0, 0.3], dy=[-0.2, 0.1])
    return transforms.score_shifts(fixture(spark, sf_dir, "points_a"), fixture(spark, sf_dir, "points_b"), grid, 2.0).select("dx", "dy", *_r("worst"))


@query(with_sql("metrics") + """
, c AS (SELECT sample % 7 AS grp, sample, region_n AS w, shift_x AS n, shift_y * 0 AS b FROM metrics), m AS (SELECT grp, max(w) AS w, max(n) AS n FROM c GROUP BY grp)
SELECT sample, round(2 * c.w / CASE WHEN m.w = 0 THEN 1 ELSE m.w END + c.n / CASE WHEN m.n = 0 THEN 1 ELSE m.n END, 6) AS score FROM c JOIN m USING (grp)""")
def score_thresholds(spark, sf_dir):
    c = fixture(spark, sf_dir, "metrics").select((F.col("sample") % 7).alias("grp"), "sample", F.col("region_n").alias("w"), F.col("shift_x").alias("n"), (F.col("shift_y") * 0).alias("b"))
    return transforms.score_thresholds(c, ["grp"]).select("sample", *_r("score"))


@query(with_sql("points_a") + """
, t AS (SELECT max(x) AS mx, max(y) AS my FROM points_a), r AS (SELECT id, mx - x AS x, my - y AS y FROM points_a, t) SELECT a.id, round(r.x, 6) AS x, round(r.y, 6) AS y FROM r a JOIN r USING (id) WHERE id % 2 = 0 OR EXISTS (SELECT 1 FROM r b WHERE b.id % 2 = 0 AND b.x = r.x AND b.y = r.y)""")
def coords_in_reference(spark, sf_dir):
    a = fixture(spark, sf_dir, "points_a")
    turned = transforms.rotate_coords(a, 180)
    return joins.coords_in_reference(a, turned.where("id % 2 = 0"), 180).select("id", *_r("x", "y"))


# ---- neighbourhoods ----


@query(with_sql("points_a", "points_b") + """
, a AS (SELECT *, 1 + id % 5 AS area FROM points_a), b AS (SELECT *, 1 + id % 4 AS area FROM points_b), d AS (SELECT a.id, b.id AS other, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d, a.area AS p, b.area AS q FROM a JOIN b ON abs(a.x - b.x) <= 1.5 AND abs(a.y - b.y) <= 1.5),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, other) AS ra, row_number() OVER (PARTITION BY other ORDER BY d, id) AS rb FROM d WHERE d <= 1.5)
SELECT id, other, round(d, 6) AS d FROM r WHERE ra <= 3 AND rb <= 3 AND greatest(p, q) / least(p, q) < 1.5""")
def region_candidates(spark, sf_dir):
    a, b = fixture(spark, sf_dir, "points_a").withColumn("area", 1 + F.col("id") % 5), fixture(spark, sf_dir, "points_b").withColumn("area", 1 + F.col("id") % 4)
    return joins.region_candidates(a, b, 1.5, 3).select("id", "other", *_r("d"))


@query(with_sql("points_a", "points_b") + """
, e AS (SELECT a.id, b.id AS other, sqrt((a.x * 10 - b.x * 10) ** 2 + (a.y - b.y) ** 2) AS d FROM points_a a JOIN points_b b ON abs(a.x - b.x) <= 1.5 AND abs(a.y - b.y) <= 1.5 AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 1.5),
r AS (SELECT *, row_number() OVER w AS k, lead(d) OVER w AS s FROM e WINDOW w AS (PARTITION BY id ORDER BY d, other)) SELECT id, other, round(d, 5) AS d FROM r WHERE k = 1 AND (s IS NULL OR d < 0.8 * s)""")
def ratio_test(spark, sf_dir):
    """Candidates near each other, matched by descriptors that the positions give."""
    described = lambda points, name: fixture(spark, sf_dir, points).withColumn(name, F.array(F.col("x") * 10, F.col("y")))
    c = joins.descriptor_candidates(described("points_a", "a"), described("points_b", "b"), 1.5, "a", "b")
    return graphs.ratio_test(c).select("id", "other", F.round("d", 5).alias("d"))


@query(with_sql("points_a") + """
, m AS (SELECT id % 7 AS grp, id, x, y, x - y AS d FROM points_a WHERE isfinite(x) AND isfinite(y))
SELECT a.grp, CAST(sum(CASE WHEN abs(a.d - b.d) > 0.5 + 0.1 * sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) THEN 1 ELSE 0 END) AS BIGINT) AS n_bad
FROM m a JOIN m b ON a.grp = b.grp AND a.id < b.id GROUP BY a.grp""")
def inconsistent_pairs(spark, sf_dir):
    m = fixture(spark, sf_dir, "points_a").select((F.col("id") % 7).alias("grp"), "id", "x", "y", (F.col("x") - F.col("y")).alias("d"))
    return graphs.inconsistent_pairs(m, ["grp"])


@query(with_sql("matches") + """
, c AS (SELECT sample, p1y, avg(p1x) AS x FROM matches GROUP BY ALL), a AS (SELECT sample, degrees(atan2(p1y - avg(p1y) OVER w, x - avg(x) OVER w)) AS a FROM c WINDOW w AS (PARTITION BY sample)),
g AS (SELECT sample, coalesce(a - lag(a) OVER (PARTITION BY sample ORDER BY a), a + 360 - max(a) OVER (PARTITION BY sample)) AS g FROM a) SELECT sample, round(max(g), 4) AS gap FROM g GROUP BY sample""")
def max_angular_gap(spark, sf_dir):
    m = fixture(spark, sf_dir, "matches").groupBy("sample", "p1y").agg(F.avg("p1x").alias("x")).withColumnRenamed("p1y", "y")
    return windows.max_angular_gap(m, ["sample"]).select("sample", F.round("gap", 4).alias("gap"))


@query(with_sql("pixels") + """
, r AS (SELECT sample_id, row_number() OVER w - 1 AS i, ims_x AS x, ims_y AS y, count(*) OVER (PARTITION BY sample_id) AS n FROM pixels WINDOW w AS (PARTITION BY sample_id ORDER BY ims_idx)),
c AS (SELECT a.sample_id, a.i, a.n, CAST(round(degrees(atan2(b.y - a.y, b.x - a.x)) / 90) AS INT) AS q, b.y - a.y AS dy, b.x - a.x AS dx FROM r a JOIN r b ON a.sample_id = b.sample_id AND b.i = (a.i + 1) % a.n),
k AS (SELECT *, ['R', 'B', 'L', 'T'][(q + 4) % 4 + 1] AS code FROM c)
SELECT k.sample_id, k.i AS seq, k.code, p.code || k.code || q1.code || q2.code AS ngram FROM k JOIN k p ON p.sample_id = k.sample_id AND p.i = (k.i + k.n - 1) % k.n JOIN k q1 ON q1.sample_id = k.sample_id AND q1.i = (k.i + 1) % k.n JOIN k q2 ON q2.sample_id = k.sample_id AND q2.i = (k.i + 2) % k.n""")
def circular_ngrams(spark, sf_dir):
    px = fixture(spark, sf_dir, "pixels").select("sample_id", "ims_idx", F.col("ims_x").alias("x"), F.col("ims_y").alias("y"))
    coded = windows.direction_codes(windows.index_rows(px, ["sample_id"], "ims_idx", "seq"), ["sample_id"])
    return windows.circular_ngrams(coded, 1, 2, ["sample_id"]).select("sample_id", "seq", "code", F.array_join("ngram", "").alias("ngram"))


@query(with_sql("pixels") + """
, s AS (SELECT sample_id, ims_idx, coalesce(abs(sqrt((lead(ims_x) OVER w - ims_x) ** 2 + (lead(ims_y) OVER w - ims_y) ** 2) - 1) <= 0.2, true) AS ok FROM pixels WINDOW w AS (PARTITION BY sample_id ORDER BY ims_idx))
SELECT sample_id, ims_idx, bool_and(ok) OVER (PARTITION BY sample_id ORDER BY ims_idx ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS valid FROM s""")
def valid_steps(spark, sf_dir):
    px = fixture(spark, sf_dir, "pixels").select("sample_id", "ims_idx", F.col("ims_x").alias("x"), F.col("ims_y").alias("y"))
    return windows.valid_steps(px, ["sample_id"], "ims_idx", before=1, after=2).select("sample_id", "ims_idx", "valid")



@query(with_sql("pixels").replace("WITH ", "WITH RECURSIVE ", 1) + """
, e AS MATERIALIZED (SELECT a.ims_idx AS a, b.ims_idx AS b FROM pixels a JOIN pixels b ON a.sample_id = b.sample_id AND abs(a.ims_x - b.ims_x) + abs(a.ims_y - b.ims_y) = 1),
r(id, root) AS (SELECT ims_idx, ims_idx FROM pixels UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id), g AS (SELECT id, min(root) AS region FROM r GROUP BY id),
k AS (SELECT region, count(*) AS size FROM g GROUP BY region) SELECT g.id AS ims_idx, region, size FROM g JOIN k USING (region) WHERE size >= 3""")
def component_sizes(spark, sf_dir):
    """Regions of touching pixels with their size, those of three pixels or more."""
    px = fixture(spark, sf_dir, "pixels").select("sample_id", "ims_idx", F.col("ims_x").cast("double").alias("x"), F.col("ims_y").cast("double").alias("y"))
    regions = graphs.pixel_regions(px, 1.0, ["sample_id"])
    sizes = A.component_sizes(regions.withColumnRenamed("region", "component"), 3).withColumnRenamed("component", "region")
    return regions.join(sizes, "region").select("ims_idx", "region", "size")


@query(with_sql("boxes") + """
, b AS (SELECT cell_idx, (cx - half) / 100 AS x0, (cx + half) / 100 AS x1, (cy - half) / 100 AS y0, (cy + half) / 100 AS y1 FROM boxes),
c AS (SELECT cell_idx, unnest([{'corner': 'topleft', 'x': x0, 'y': y0}, {'corner': 'topright', 'x': x1, 'y': y0}, {'corner': 'bottomright', 'x': x1, 'y': y1}, {'corner': 'bottomleft', 'x': x0, 'y': y1}]) AS p FROM b)
SELECT cell_idx, p.corner AS corner, round(p.x, 6) AS x, round(p.y, 6) AS y, CASE WHEN p.corner LIKE '%left' THEN 1.0 ELSE 9.0 END AS other_x, CASE WHEN p.corner LIKE 'top%' THEN 2.0 ELSE 7.0 END AS other_y FROM c WHERE cell_idx % 3 <> 0""")
def pair_corners(spark, sf_dir):
    """Corners of the cells' boxes, in an order and direction that change from cell to cell, paired with those of one slightly turned quadrangle; every third ring stands on a corner and
    has no four labels."""
    b = fixture(spark, sf_dir, "boxes").selectExpr("cell_idx", "cx / 100 AS x", "cy / 100 AS y", "half / 100 AS h")
    pt = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x, y, h = F.col("x"), F.col("y"), F.col("h")
    four = [pt(x - h, y - h), pt(x + h, y - h), pt(x + h, y + h), pt(x - h, y + h)]
    turned = [F.array(*[four[(i + k) % 4] for i in range(5)]) for k in range(4)] + [F.array(*[four[(k - i) % 4] for i in range(5)]) for k in range(4)]
    ring = F.get(F.array(*turned), F.pmod("cell_idx", F.lit(8)))
    diamond = F.array(pt(x - h, y), pt(x, y - h), pt(x + h, y), pt(x, y + h), pt(x - h, y))
    other = F.array(*[pt(F.lit(a), F.lit(c)) for a, c in ((9.0, 7.0), (1.0, 7.0), (1.0, 2.0), (9.0, 2.0), (9.0, 7.0))])
    own = F.when(F.col("cell_idx") % 3 == 0, diamond).otherwise(ring)
    out = b.select("cell_idx", F.explode(G.pair_corners(own, other)).alias("p"))
    return out.select("cell_idx", "p.corner", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"), "p.other_x", "p.other_y")


@query(with_sql("labels_raster").replace("WITH", "WITH RECURSIVE", 1) + """
, levels AS (SELECT unnest([20, 30, 40]) AS t), px AS MATERIALIZED (SELECT t, row, col, CAST(row AS BIGINT) * 4294967296 + col AS id FROM labels_raster, levels WHERE label > t),
e AS MATERIALIZED (SELECT a.t, a.id AS a, b.id AS b FROM px a JOIN px b ON a.t = b.t AND abs(a.row - b.row) + abs(a.col - b.col) = 1),
reach AS (SELECT t, id AS a, id AS b FROM px UNION SELECT r.t, r.a, e.b FROM reach r JOIN e ON e.t = r.t AND e.a = r.b),
root AS (SELECT t, a AS id, min(b) AS component FROM reach GROUP BY t, a)
SELECT CAST(px.t AS DOUBLE) AS threshold, component, count(*) AS area, round(avg(row), 6) AS c_row, round(avg(col), 6) AS c_col, min(row) AS r0, min(col) AS c0, max(row) AS r1, max(col) AS c1
FROM px JOIN root ON root.t = px.t AND root.id = px.id GROUP BY px.t, component""")
def threshold_components(spark, sf_dir):
    """Components of a raster at three thresholds in one pass."""
    from mosaica.operators import sweep

    raster = fixture(spark, sf_dir, "labels_raster").select("row", "col", F.col("label").cast("double").alias("value"))
    return sweep.threshold_components(raster, [20, 30, 40]).select("threshold", "component", "area", *_r("c_row", "c_col"), "r0", "c0", "r1", "c1")
