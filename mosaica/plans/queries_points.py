"""Queries for lattices, match sets, shapes, marks, candidate moves and fitted coefficients."""

from __future__ import annotations

from pyspark.sql import functions as F

from mosaica.functions import scalars
from mosaica.operators import graphs, joins, models, rasters, transforms
from mosaica.plans import jobs
from mosaica.plans.fixtures import fixture, with_sql
from mosaica.plans.queries_models import _lag_sql, _wide
from mosaica.plans.queries_space import _rows
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


def _recursive(*names: str) -> str:
    return with_sql(*names).replace("WITH ", "WITH RECURSIVE ", 1)


# ---- point sets ----


@query(_recursive("pixels") + """
, q AS MATERIALIZED (SELECT sample_id, ims_idx AS id, ims_x + (ims_idx % 3 - 1) * 0.02 AS x, ims_y + CASE WHEN ims_idx % 4 = 0 THEN 0.3 ELSE 0 END AS y FROM pixels),
s AS (SELECT a.id, b.id AS other, sqrt((b.x - a.x) ** 2 + (b.y - a.y) ** 2) AS d, degrees(atan2(b.y - a.y, b.x - a.x)) AS t FROM q a JOIN q b ON a.sample_id = b.sample_id AND a.id <> b.id AND abs(a.x - b.x) < 1.07 AND abs(a.y - b.y) < 1.07),
e AS MATERIALIZED (SELECT id, other FROM s WHERE d > 0.93 AND d < 1.07 AND abs(t - round(t / 90) * 90) < 9),
r(id, root) AS (SELECT id, id FROM q UNION SELECT e.other, r.root FROM r JOIN e ON e.id = r.id), c AS (SELECT id, min(root) AS component FROM r GROUP BY id)
SELECT id, component FROM c WHERE component IN (SELECT component FROM c GROUP BY component HAVING count(*) > 9)""")
def filter_lattice(spark, sf_dir):
    """Pixels a little off their places, every fourth one far off; small groups of the others leave."""
    x = F.col("ims_x") + (F.col("ims_idx") % 3 - 1) * 0.02
    y = F.col("ims_y") + F.when(F.col("ims_idx") % 4 == 0, 0.3).otherwise(0.0)
    pts = fixture(spark, sf_dir, "pixels").select("sample_id", F.col("ims_idx").alias("id"), x.alias("x"), y.alias("y"))
    return graphs.filter_lattice(pts, 9, ["sample_id"]).select("id", "component")


@query(with_sql("sheet", "labels_raster") + """
, n AS (SELECT count(DISTINCT label) AS n FROM labels_raster WHERE label <> 0), f AS (SELECT seq, CASE WHEN seq % 4 = 0 THEN 'automatic-1' ELSE coords_filename END AS name FROM sheet)
SELECT seq, 'all' AS regions, coalesce(contains(name, 'automatic'), false) OR n = 1 AS by_location FROM f, n UNION ALL SELECT seq, 'one', true FROM f""")
def index_mode(spark, sf_dir):
    """Sources with, with another and without a name, against all regions and against one."""
    f = fixture(spark, sf_dir, "sheet").select("seq", F.when(F.col("seq") % 4 == 0, "automatic-1").otherwise(F.col("coords_filename")).alias("coords_filename"))
    regions = fixture(spark, sf_dir, "labels_raster").where("label <> 0").select(F.col("label").alias("region"))
    of = lambda r, name: graphs.index_mode(f, r).select("seq", F.lit(name).alias("regions"), "by_location")
    return of(regions, "all").unionByName(of(regions.where("region = 7"), "one"))


@query(_recursive("pixels") + """
, q AS MATERIALIZED (SELECT ims_idx, ims_x + 26 * floor(ims_idx / 500) AS x, ims_y AS y FROM pixels),
e AS MATERIALIZED (SELECT a.ims_idx AS a, b.ims_idx AS b FROM q a JOIN q b ON abs(a.x - b.x) + abs(a.y - b.y) = 1),
r(id, root) AS (SELECT ims_idx, ims_idx FROM q UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id), c AS (SELECT id, min(root) AS region FROM r GROUP BY id)
SELECT id AS ims_idx, region, row_number() OVER (PARTITION BY region ORDER BY id) - 1 AS new_idx FROM c WHERE region IN (SELECT region FROM c WHERE id % 97 = 0)""")
def reindex_region(spark, sf_dir):
    """Pixels of samples side by side; matched are those whose number 97 divides."""
    px = fixture(spark, sf_dir, "pixels").select("ims_idx", (F.col("ims_x") + 26 * F.floor(F.col("ims_idx") / 500)).cast("double").alias("x"), F.col("ims_y").cast("double").alias("y"))
    return joins.reindex_region(px, px.where("ims_idx % 97 = 0"), 1.0).select("ims_idx", "region", F.col("new_idx").cast("long").alias("new_idx"))


@query(with_sql("points_a") + """
, m AS (SELECT id % 3 AS line, id, CASE WHEN id % 3 = 2 THEN 0.1 ELSE 1 END * x AS x, y, (id % 10) * 0.05 * (1 + id % 3) AS d, 5 + id % 8 AS length FROM points_a),
s AS MATERIALIZED (SELECT n, m.* FROM (SELECT DISTINCT line, length AS n FROM m WHERE length > 10) JOIN m USING (line) WHERE length >= n),
z AS (SELECT line, n, count(*) AS matches, sqrt((max(x) - min(x)) ** 2 + (max(y) - min(y)) ** 2) AS diameter FROM s GROUP BY ALL),
a AS (SELECT line, n, degrees(atan2(y - avg(y) OVER w, x - avg(x) OVER w)) AS a FROM s WINDOW w AS (PARTITION BY line, n)),
g AS (SELECT line, n, coalesce(a - lag(a) OVER (PARTITION BY line, n ORDER BY a), a + 360 - max(a) OVER (PARTITION BY line, n)) AS g FROM a), gap AS (SELECT line, n, max(g) AS gap FROM g GROUP BY ALL),
b AS (SELECT s.line, s.n, count(*) AS n_bad FROM s JOIN s t ON s.line = t.line AND s.n = t.n AND s.id < t.id AND abs(s.x - t.x) < 9 AND abs(s.d - t.d) > 0.5 + 0.1 * sqrt((s.x - t.x) ** 2 + (s.y - t.y) ** 2) GROUP BY ALL)
SELECT z.line, z.n, matches, coalesce(n_bad, 0) AS n_bad, round(gap, 4) AS gap, CASE WHEN coalesce(n_bad, 0) > 0 THEN 0.0 ELSE round((1 - gap / 360) * sqrt(matches), 4) END AS score
FROM z JOIN gap ON gap.line = z.line AND gap.n = z.n LEFT JOIN b ON b.line = z.line AND b.n = z.n WHERE diameter > 0.75 * 52 AND gap < 200""")
def score_match_sets(spark, sf_dir):
    """Three lines: one consistent, one with pairs that are not, one too narrow."""
    line = F.col("id") % 3
    m = fixture(spark, sf_dir, "points_a").select(
        line.alias("line"), "id", (F.when(line == 2, 0.1).otherwise(1.0) * F.col("x")).alias("x"), "y", ((F.col("id") % 10) * 0.05 * (1 + line)).alias("d"), (5 + F.col("id") % 8).alias("length")
    )
    return graphs.score_match_sets(m, 52.0).select("line", "n", "matches", F.coalesce("n_bad", F.lit(0)).alias("n_bad"), *_r("gap", "score", digits=4))


@query(with_sql("matches") + """
, c AS (SELECT sample, p1y, avg(p1x) AS x FROM matches GROUP BY ALL), a AS (SELECT sample, p1y, degrees(atan2(p1y - avg(p1y) OVER w, x - avg(x) OVER w)) AS a FROM c WINDOW w AS (PARTITION BY sample)),
k AS (SELECT unnest([2, 3, 4, 5, 6, 7, 8, 9, 10, 12]) AS b), s AS (SELECT b, unnest(range(-45, 46, 5)) AS s FROM k),
p AS MATERIALIZED (SELECT sample, p1y, b, s, floor((a + s - 360 * floor((a + s) / 360)) / (360.0 / b)) AS bin FROM a, s),
n AS (SELECT sample, b, s, bin, count(*) AS n FROM p GROUP BY ALL),
w AS (SELECT p.sample, p.p1y, pow(avg(1.0 / n), 1.5) AS w FROM p JOIN n ON n.sample = p.sample AND n.b = p.b AND n.s = p.s AND n.bin = p.bin GROUP BY ALL)
SELECT sample, CAST(p1y AS INT) AS id, round(w / sum(w) OVER (PARTITION BY sample) * count(*) OVER (PARTITION BY sample), 6) AS weight FROM w""")
def angular_weights(spark, sf_dir):
    m = fixture(spark, sf_dir, "matches").groupBy("sample", "p1y").agg(F.avg("p1x").alias("x")).select("sample", F.col("p1y").cast("int").alias("id"), "x", F.col("p1y").alias("y"))
    return graphs.angular_weights(m, ["sample"]).select("sample", "id", *_r("weight"))


_MOVES = [(i, dx, dy, turn) for i, (dx, dy, turn) in enumerate((dx, dy, t) for dx in (-3.0, 0.25, 9.0) for dy in (-1.5, 0.0) for t in (-6.0, 0.0, 3.0))]


@query(with_sql("points_a", "grid_pixels") + f"""
, g(candidate, dx, dy, t) AS (VALUES {", ".join(f"({i}, CAST({dx} AS DOUBLE), CAST({dy} AS DOUBLE), radians({t}))" for i, dx, dy, t in _MOVES)}),
q AS MATERIALIZED (SELECT candidate, ims_idx, col * cos(t) - row * sin(t) + dx AS x, col * sin(t) + row * cos(t) + dy AS y FROM (SELECT * FROM grid_pixels WHERE col < 40) p, g),
c AS (SELECT candidate, avg(CASE WHEN x >= -2.5 AND x <= 43.5 AND y >= -3 AND y <= 22.5 THEN 1.0 ELSE 0.0 END) AS coverage FROM q GROUP BY candidate),
n AS (SELECT candidate, ims_idx, a.id, sqrt((q.x - a.x) ** 2 + (q.y - a.y) ** 2) AS d FROM q JOIN points_a a ON abs(q.x - a.x) <= 1 AND abs(q.y - a.y) <= 1 WHERE candidate IN (SELECT candidate FROM c WHERE coverage >= 0.9)),
o AS (SELECT * FROM n WHERE d <= 1 QUALIFY row_number() OVER (PARTITION BY candidate, ims_idx ORDER BY d, id) = 1), m AS (SELECT candidate, id, min(d) AS d FROM o GROUP BY ALL)
SELECT candidate, round(any_value(coverage), 6) AS coverage, round(avg(1.0 + id % 5), 6) AS mean_weight, count(*) AS n_matches, round(avg(d), 6) AS mean_distance, round(sum(d * (1 + id % 5)) / count(*), 6) AS weighted_distance FROM m JOIN c USING (candidate) GROUP BY candidate""")
def grid_search(spark, sf_dir):
    """Eighteen moves of the pixels over weighted points; those that leave a tenth of the pixels outside a box go."""
    pts = fixture(spark, sf_dir, "points_a").withColumn("weight", 1.0 + F.col("id") % 5)
    px = fixture(spark, sf_dir, "grid_pixels").where("col < 40").select(F.col("ims_idx").alias("id"), F.col("col").cast("double").alias("x"), F.col("row").cast("double").alias("y"))
    grid = _rows(spark, *[f"{i} candidate, {dx}d dx, {dy}d dy, {t}d rotation" for i, dx, dy, t in _MOVES])
    corner = lambda x, y: f"named_struct('x', {x}d, 'y', {y}d)"
    ring = ", ".join(corner(x, y) for x, y in ((-2.5, -3.0), (43.5, -3.0), (43.5, 22.5), (-2.5, 22.5), (-2.5, -3.0)))
    out = transforms.grid_search(pts, px, grid, _rows(spark, f"array({ring}) ring"), 0.9)
    return out.select("candidate", *_r("coverage", "mean_weight"), "n_matches", *_r("mean_distance", "weighted_distance"))


# ---- shapes and marks ----


def _hu_sql() -> str:
    """Hu invariants of labels from central moments."""
    orders = [(2, 0), (1, 1), (0, 2), (3, 0), (2, 1), (1, 2), (0, 3)]
    moments = ", ".join(f"sum((l.col - cx) ** {p} * (l.row - cy) ** {q}) / pow(n, {1 + (p + q) / 2}) AS n{p}{q}" for p, q in orders)
    level = lambda h: f"CASE WHEN abs({h}) > 1e-30 THEN sign({h}) * log10(abs({h})) ELSE 0 END"
    hu = [
        "n20 + n02", "(n20 - n02) ** 2 + 4 * n11 ** 2", "u * u + v * v", "s * s + t * t", "u * s * (s * s - 3 * t * t) + v * t * (3 * s * s - t * t)",
        "(n20 - n02) * (s * s - t * t) + 4 * n11 * s * t", "v * s * (s * s - 3 * t * t) - u * t * (3 * s * s - t * t)",
    ]
    return f"""
, m AS (SELECT label, avg(col) AS cx, avg(row) AS cy, CAST(count(*) AS DOUBLE) AS n FROM labels_raster WHERE label <> 0 GROUP BY label),
c AS (SELECT l.label, {moments} FROM labels_raster l JOIN m USING (label) GROUP BY l.label, n),
w AS (SELECT *, n30 + n12 AS s, n21 + n03 AS t, n30 - 3 * n12 AS u, 3 * n21 - n03 AS v FROM c),
h AS (SELECT label, {", ".join(f"{level(f'({e})')} AS h{i}" for i, e in enumerate(hu))} FROM w)"""


@query(with_sql("labels_raster") + _hu_sql() + f"""
, d AS (SELECT a.label AS id, b.label AS other, {" + ".join(f"abs(a.h{i} - b.h{i})" for i in range(7))} AS d FROM h a JOIN h b ON abs(a.label - b.label) BETWEEN 1 AND 3)
SELECT id, other, round(d, 3) AS shape_distance FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, other) = 1""")
def best_shape_match(spark, sf_dir):
    """Each label's most similar one of the labels up to three away."""
    px = fixture(spark, sf_dir, "labels_raster").where("label <> 0").withColumnRenamed("label", "id")
    ids = px.select("id").distinct()
    pairs = ids.withColumn("other", F.explode(F.array(*[F.col("id") + k for k in (-3, -2, -1, 1, 2, 3)]))).join(ids.withColumnRenamed("id", "other"), "other")
    return graphs.best_shape_match(rasters.shape_distance(pairs, rasters.region_moments(px))).select("id", "other", *_r("shape_distance", digits=3))


@query(_recursive("labels_raster") + """
, q AS MATERIALIZED (SELECT row, col, row * 4294967296 + col AS id FROM labels_raster WHERE label > 30),
e AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM q a JOIN q b ON abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 AND a.id <> b.id),
r(id, root) AS (SELECT id, id FROM q UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id), c AS (SELECT id, min(root) AS component FROM r GROUP BY id),
p AS (SELECT component, count(*) AS area, avg(row) AS cr, avg(col) AS cc, max(row) - min(row) + 1 AS h, max(col) - min(col) + 1 AS w FROM c JOIN q USING (id) GROUP BY component),
g AS (SELECT * FROM p WHERE area >= pi() * 0.49 AND area <= 16 AND h < 2 * w AND w < 2 * h) SELECT component, round(cc * 2 / 5, 6) AS x, round(cr * 2 / 5, 6) AS y, area FROM g WHERE (SELECT count(*) FROM g) >= 6""")
def detect_marks(spark, sf_dir):
    px = fixture(spark, sf_dir, "labels_raster").select("row", "col", F.col("label").alias("value"))
    return rasters.detect_marks(px, 30, 8.0, 2.0, 5.0, 0.7).select("component", *_r("x", "y"), "area")


_BLOCKS = """
, b AS (SELECT 'S' || CAST(CAST(floor(col / 25) AS INT) AS VARCHAR) AS sample_id, row, col % 25 AS col, col AS whole FROM grid_pixels WHERE col % 25 < 24 AND row < 18),
l AS (SELECT sample_id, row, col, whole, CAST(1 + floor(row / 3) * 8 + floor(col / 3) AS INT) AS cell_idx FROM b),
f AS (SELECT sample_id, cell_idx FROM l GROUP BY ALL HAVING count(*) = 9)"""


@query(with_sql("grid_pixels", "raster") + _BLOCKS + """
SELECT l.sample_id, l.cell_idx, any_value(floor((l.cell_idx - 1) % 8) * 3 + 1.5) AS x, any_value(floor((l.cell_idx - 1) / 8) * 3 + 1.5) AS y, round(avg(CASE WHEN channel = 1 THEN value END), 4) AS c1, round(avg(CASE WHEN channel = 2 THEN value END), 4) AS c2, 1.0 AS covered
FROM l JOIN f ON f.sample_id = l.sample_id AND f.cell_idx = l.cell_idx JOIN raster r ON r.row = l.row AND r.col = l.whole GROUP BY l.sample_id, l.cell_idx""")
def cells_on_pixels(spark, sf_dir):
    """Whole blocks of three by three pixels, each a unit square from its corner, as cells: their centres, marker means of two channels, and the share that the pixels cover, which is all. Labels repeat in every sample."""
    at = lambda df, *more: df.where("col % 25 < 24 and row < 18").select(F.concat(F.lit("S"), F.floor(F.col("col") / 25).cast("int").cast("string")).alias("sample_id"), "row", (F.col("col") % 25).cast("int").alias("col"), *more)
    labels = at(fixture(spark, sf_dir, "grid_pixels")).withColumn("label", (1 + F.floor(F.col("row") / 3) * 8 + F.floor(F.col("col") / 3)).cast("int"))
    labels = labels.join(labels.groupBy("sample_id", "label").count().where("count = 9").drop("count"), ["sample_id", "label"])
    px = fixture(spark, sf_dir, "grid_pixels").select(F.concat(F.lit("S"), F.floor(F.col("col") / 25).cast("int").cast("string")).alias("sample_id"), "ims_idx", (F.col("col") % 25).cast("double").alias("x"), F.col("row").cast("double").alias("y"))
    out = jobs.cells_on_pixels(labels, px, at(fixture(spark, sf_dir, "raster"), "channel", "value"), 1.0, [1, 2], 10.0)
    covered = out["overlaps"].groupBy("sample_id", "cell_idx").agg(F.round(F.sum("overlap"), 4).alias("covered"))
    marks = out["markers"].select("sample_id", "cell_idx", F.round("1", 4).alias("c1"), F.round("2", 4).alias("c2"))
    keys = ["sample_id", "cell_idx"]
    return out["centroids"].select(*keys, *_r("x", "y")).join(marks, keys).join(covered, keys, "left")


# ---- fits ----


@query(with_sql("cell_annotation") + """
SELECT sample_id, count(*) AS n, round(avg(CASE WHEN status <> 'F' THEN value END), 4) AS one, round(avg(CASE WHEN status = 'F' THEN value END) - avg(CASE WHEN status <> 'F' THEN value END), 4) AS f FROM cell_annotation GROUP BY sample_id""")
def coef_table(spark, sf_dir):
    """Coefficients of a model with one two-valued covariate, side by side."""
    d = fixture(spark, sf_dir, "cell_annotation").withColumn("one", F.lit(1.0)).withColumn("f", (F.col("status") == "F").cast("double"))
    return models.coef_table(models.fit_ols(d, ["sample_id"], "value", ["one", "f"]), ["sample_id"], ["one", "f"]).select("sample_id", "n", *_r("one", "f", digits=4))


@query(_lag_sql() + """,
b AS (SELECT mz, sample_id, max(CASE WHEN term = '(Intercept)' THEN estimate END) AS b0, max(CASE WHEN term = 't1' THEN estimate END) AS b1, max(CASE WHEN term = 't2' THEN estimate END) AS b2, max(CASE WHEN term = 't3' THEN estimate END) AS b3, max(CASE WHEN term = 'rho' THEN estimate END) AS rho FROM fit GROUP BY ALL),
p AS (SELECT g.mz, g.sample_id, g.ims_idx, g.y, b0 + b1 * x1 + b2 * x2 + b3 * x3 AS trend, rho * l AS signal FROM g JOIN b ON b.mz = g.mz AND b.sample_id = g.sample_id)
SELECT mz, sample_id, ims_idx, round(trend, 3) + 0.0 AS trend, round(signal, 3) + 0.0 AS signal, round(y - trend - signal, 3) + 0.0 AS residual FROM p""")
def predict_lag(spark, sf_dir):
    """Trend, signal and residual of the lag model at the pixels that it was fitted on."""
    wide, types = _wide(spark, sf_dir)
    x, names = models.design(models.zscore(wide, "value", ["mz"], "z"), types)
    out = models.predict_lag(x, models.fit_lag(x, ["mz", "sample_id"], "z", names), ["mz", "sample_id"], "z", names)
    return out.select("mz", "sample_id", "ims_idx", *[(F.round(c, 3) + 0.0).alias(c) for c in ("trend", "signal", "residual")])


@query("""WITH s AS (SELECT s_suppkey AS id, 1 + s_suppkey % 4 AS df, CAST(s_acctbal AS DOUBLE) / 1000 AS t FROM supplier)
SELECT id, round(CASE df WHEN 1 THEN 1 - 2 / pi() * atan(abs(t)) WHEN 2 THEN 1 - abs(t) / sqrt(2 + t * t) WHEN 3 THEN 1 - 2 / pi() * (abs(t) / sqrt(3) / (1 + t * t / 3) + atan(abs(t) / sqrt(3)))
  ELSE 1 - 0.75 * abs(t) / sqrt(1 + t * t / 4) * (1 - t * t / 12 / (1 + t * t / 4)) END, 6) AS p FROM s""")
def t_pvalue(spark, sf_dir):
    """One to four degrees of freedom, of which the distribution has a closed form."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("id"), (1 + F.col("s_suppkey") % 4).cast("double").alias("df"), (F.col("s_acctbal").cast("double") / 1000).alias("t"))
    return s.select("id", F.round(scalars.t_pvalue(F.col("t"), F.col("df")), 6).alias("p"))


@query(with_sql("pixels", "boxes") + """
, k AS (SELECT DISTINCT sample_id FROM boxes), t AS (SELECT sample_id, cell_idx % 500 AS ims_idx, sum(half) AS "a:b" FROM boxes GROUP BY ALL)
SELECT p.sample_id, p.ims_idx, "a:b" FROM pixels p JOIN k ON k.sample_id = p.sample_id LEFT JOIN t ON t.sample_id = p.sample_id AND t.ims_idx = p.ims_idx""")
def add_interactions(spark, sf_dir):
    """Terms of some pixels beside the pixels of the samples that have terms; the others keep nulls."""
    boxes, px = fixture(spark, sf_dir, "boxes"), fixture(spark, sf_dir, "pixels").select("sample_id", "ims_idx")
    terms = boxes.groupBy("sample_id", (F.col("cell_idx") % 500).alias("ims_idx")).agg(F.sum("half").alias("a:b"))
    terms = terms.join(px.select("sample_id").distinct(), "sample_id", "left_semi")
    return graphs.add_interactions(px.join(boxes.select("sample_id").distinct(), "sample_id", "left_semi"), terms)
