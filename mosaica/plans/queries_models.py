"""Queries for grouped models."""

from __future__ import annotations

from pyspark.sql import functions as F

from mosaica.operators import models
from mosaica.plans import jobs
from mosaica.plans.fixtures import cells, fixture, with_sql
from mosaica.plans.queries_joins import _positions
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


@query(with_sql("matches") + """
, s AS (SELECT sample, count(*) AS n, regr_slope(p2x, p1x) AS b, regr_intercept(p2x, p1x) AS a, sqrt(greatest(0, regr_syy(p2x, p1x) - regr_slope(p2x, p1x) ** 2 * regr_sxx(p2x, p1x)) / (count(*) - 2) / regr_sxx(p2x, p1x)) AS se FROM matches GROUP BY sample)
SELECT sample, n, round(a, 5) AS intercept, round(b, 5) AS slope, round(se, 5) AS slope_se FROM s""")
def fit_ols(spark, sf_dir):
    m = fixture(spark, sf_dir, "matches").withColumn("one", F.lit(1.0))
    fit = models.fit_ols(m, ["sample"], "p2x", ["one", "p1x"])
    at = lambda t, c: F.max(F.when(F.col("term") == t, F.col(c)))
    return fit.groupBy("sample", "n").agg(F.round(at("one", "estimate"), 5).alias("intercept"), F.round(at("p1x", "estimate"), 5).alias("slope"), F.round(at("p1x", "std_error"), 5).alias("slope_se"))


def _robust_sql(rounds: int = 30) -> str:
    """Weighted least squares round by round: Huber weights in the first three, then bisquare, the scale by the median of absolute residuals."""
    fit = "SELECT sample, regr_slope(p2x, p1x) AS b, regr_intercept(p2x, p1x) AS a FROM matches GROUP BY sample"
    sql = f", f0 AS MATERIALIZED ({fit})"
    for k in range(rounds):
        weight = "CASE WHEN u <= 1.345 THEN 1 ELSE 1.345 / u END" if k < 3 else "CASE WHEN u < 4.685 THEN (1 - (u / 4.685) ** 2) ** 2 ELSE 0 END"
        sql += f"""
, r{k} AS (SELECT sample, p1x AS x, p2x AS y, abs(p2x - a - b * p1x) AS r FROM matches JOIN f{k} USING (sample)),
w{k} AS (SELECT sample, x, y, {weight} AS w FROM (SELECT sample, x, y, r / greatest(1.4826 * median(r) OVER (PARTITION BY sample), 1e-12) AS u FROM r{k})),
m{k} AS (SELECT sample, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM w{k} GROUP BY sample),
f{k + 1} AS MATERIALIZED (SELECT sample, b, my - b * mx AS a FROM (SELECT sample, mx, my, sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) ** 2) AS b FROM w{k} JOIN m{k} USING (sample) GROUP BY ALL))"""
    return sql + f" SELECT sample, 'one' AS term, round(a, 4) AS estimate FROM f{rounds} UNION ALL SELECT sample, 'p1x', round(b, 4) FROM f{rounds}"


@query(with_sql("matches") + _robust_sql())
def fit_robust(spark, sf_dir):
    m = fixture(spark, sf_dir, "matches").withColumn("one", F.lit(1.0))
    return models.fit_robust(m, ["sample"], "p2x", ["one", "p1x"]).select("sample", "term", *_r("estimate", digits=4))


@query(with_sql("cell_annotation") + """
, m AS (SELECT sample_id, ln(avg(CASE WHEN status <> 'F' THEN value END)) AS a, ln(avg(CASE WHEN status = 'F' THEN value END)) AS b FROM cell_annotation GROUP BY sample_id)
SELECT sample_id, 'one' AS term, round(a, 5) AS estimate FROM m UNION ALL SELECT sample_id, 'f', round(b - a, 5) FROM m""")
def fit_glm_gamma(spark, sf_dir):
    """With one two-valued covariate the likelihood is greatest at the means of the two kinds."""
    d = fixture(spark, sf_dir, "cell_annotation").withColumn("one", F.lit(1.0)).withColumn("f", (F.col("status") == "F").cast("double"))
    return models.fit_glm(d, ["sample_id"], "value", ["one", "f"]).select("sample_id", "term", *_r("estimate", digits=5))


def _wide(spark, sf_dir):
    """m/z values on pixels with the share of each cell type at the pixel."""
    px = fixture(spark, sf_dir, "pixels")
    v = fixture(spark, sf_dir, "spectra").withColumn("mz", F.lit(1000.0) + F.floor(F.col("mz")) % 2).groupBy("ims_idx", "mz").agg(F.log(F.sum("intensity")).alias("value"))
    t = fixture(spark, sf_dir, "cell_annotation").select((F.col("cell_idx") % 2000).alias("ims_idx"), F.concat(F.lit("t"), F.left("celltype", F.lit(1))).alias("celltype"), F.lit(1.0).alias("one"))
    types = ["t1", "t2", "t3"]
    w = t.groupBy("ims_idx").pivot("celltype", types).agg(F.sum("one")).fillna(0.0)
    return px.join(v, "ims_idx").join(w, "ims_idx", "left").fillna(0.0, subset=types), types


def _lag_sql(powers: int = 8, rounds: int = 70) -> str:
    """The lag model in SQL. ln det(I - rho W) = -sum rho^k tr(W^k) / k by exact traces: W^j is joined up entry by entry, tr(W^2j) is the sum of its squared entries, odd traces are 0. Seventeen orders
    are exact to many digits at the small rho of these tables. The normal equations are solved by symmetric sweeps over four pivots, rho by golden section."""
    cols = ["x0", "x1", "x2", "x3", "y", "l"]
    cell = lambda i, j: f"m{min(i, j)}{max(i, j)}"
    every = [(i, j) for i in range(6) for j in range(i, 6)]
    sql = """
, v AS (SELECT ims_idx, 1000.0 + floor(mz) % 2 AS mz, ln(sum(intensity)) AS value FROM spectra GROUP BY ALL),
t AS (SELECT cell_idx % 2000 AS ims_idx, left(celltype, 1) AS k FROM cell_annotation),
c AS (SELECT ims_idx, count(*) FILTER (WHERE k = '1') AS x1, count(*) FILTER (WHERE k = '2') AS x2, count(*) FILTER (WHERE k = '3') AS x3 FROM t GROUP BY ims_idx),
d AS MATERIALIZED (SELECT CAST(v.mz AS DOUBLE) AS mz, p.sample_id, p.ims_idx, ims_x, ims_y, 1.0 AS x0, coalesce(x1, 0) AS x1, coalesce(x2, 0) AS x2, coalesce(x3, 0) AS x3,
  (value - avg(value) OVER (PARTITION BY v.mz)) / stddev_samp(value) OVER (PARTITION BY v.mz) AS y FROM pixels p JOIN v ON v.ims_idx = p.ims_idx LEFT JOIN c ON c.ims_idx = p.ims_idx),
e AS MATERIALIZED (SELECT a.mz, a.sample_id, a.ims_idx AS i, b.ims_idx AS j, b.y FROM d a JOIN d b ON a.mz = b.mz AND a.sample_id = b.sample_id AND abs(a.ims_x - b.ims_x) + abs(a.ims_y - b.ims_y) = 1),
g AS MATERIALIZED (SELECT d.*, coalesce(s, 0) AS l FROM d LEFT JOIN (SELECT mz, sample_id, i, sum(y) AS s FROM e GROUP BY ALL) w ON w.mz = d.mz AND w.sample_id = d.sample_id AND w.i = d.ims_idx),
w1 AS MATERIALIZED (SELECT mz, sample_id, i, j, 1.0 AS n FROM e)"""
    for k in range(2, powers + 1):
        sql += f", w{k} AS MATERIALIZED (SELECT a.mz, a.sample_id, a.i, e.j, sum(a.n) AS n FROM w{k - 1} a JOIN e ON e.mz = a.mz AND e.sample_id = a.sample_id AND e.i = a.j GROUP BY ALL)"
    traces = " UNION ALL ".join(f"SELECT mz, sample_id, {2 * k} AS k, sum(n * n) AS t FROM w{k} GROUP BY ALL" for k in range(1, powers + 1))
    wide = ", ".join(f"coalesce(max(CASE WHEN k = {2 * k} THEN t END), 0) AS t{2 * k}" for k in range(1, powers + 1))
    sql += f", traces AS ({traces}), tr AS MATERIALIZED (SELECT mz, sample_id, {wide} FROM traces GROUP BY ALL)"
    sums = ", ".join(f"sum({cols[i]} * {cols[j]}) AS {cell(i, j)}" for i, j in every)
    sql += f", s0 AS (SELECT mz, sample_id, count(*) AS n, {sums} FROM g GROUP BY ALL)"
    for p in range(4):
        new = []
        for i, j in every:
            if i == j == p:
                v = f"-1 / {cell(p, p)}"
            elif p in (i, j):
                v = f"{cell(i, j)} / {cell(p, p)}"
            else:
                v = f"{cell(i, j)} - {cell(i, p)} * {cell(j, p)} / {cell(p, p)}"
            new.append(f"{v} AS {cell(i, j)}")
        sql += f", s{p + 1} AS (SELECT mz, sample_id, n, {', '.join(new)} FROM s{p})"
    det = lambda r: " + ".join(f"pow({r}, {2 * k}) * t{2 * k} / {2 * k}" for k in range(1, powers + 1))  # noqa: E731  minus ln det
    loss = lambda r: f"({det(r)} + n / 2 * ln((m44 - 2 * {r} * m45 + {r} * {r} * m55) / n))"
    third = (5**0.5 - 1) / 2
    a, b = f"(hi - {third!r} * (hi - lo))", f"(lo + {third!r} * (hi - lo))"
    keep = "mz, sample_id, n, m44, m45, m55, " + ", ".join(f"t{2 * k}" for k in range(1, powers + 1))
    sql += f""", z AS MATERIALIZED (SELECT s4.*, tr.* EXCLUDE (mz, sample_id) FROM s4 JOIN tr ON tr.mz = s4.mz AND tr.sample_id = s4.sample_id),
golden AS (SELECT {keep}, 0 AS k, CAST(-0.24 AS DOUBLE) AS lo, CAST(0.24 AS DOUBLE) AS hi FROM z
  UNION ALL SELECT {keep}, k + 1, CASE WHEN {loss(a)} < {loss(b)} THEN lo ELSE {a} END, CASE WHEN {loss(a)} < {loss(b)} THEN {b} ELSE hi END FROM golden WHERE k < {rounds}),
r AS (SELECT mz, sample_id, (lo + hi) / 2 AS rho FROM golden WHERE k = {rounds}),
f AS (SELECT z.*, rho, (m44 - 2 * rho * m45 + rho * rho * m55) AS ss FROM z JOIN r ON r.mz = z.mz AND r.sample_id = z.sample_id),
q AS (SELECT *, ss / n AS s2, 1 / ({" + ".join(f"{2 * k - 1} * pow(rho, {2 * k - 2}) * t{2 * k}" for k in range(1, powers + 1))} + n / 2 * (2 * m55 / ss - pow(2 * (rho * m55 - m45) / ss, 2))) AS vr FROM f),
fit AS (SELECT mz, sample_id, n, 'rho' AS term, rho AS estimate, sqrt(vr) AS std_error FROM q"""
    for i, name in enumerate(("(Intercept)", "t1", "t2", "t3")):
        sql += f" UNION ALL SELECT mz, sample_id, n, '{name}', {cell(i, 4)} - rho * {cell(i, 5)}, sqrt(-s2 * {cell(i, i)} + {cell(i, 5)} * {cell(i, 5)} * vr) FROM q"
    return with_sql("pixels", "spectra", "cell_annotation").replace("WITH", "WITH RECURSIVE", 1) + sql + ")"


@query(_lag_sql() + " SELECT mz, sample_id, n, term, round(estimate, 4) AS estimate, round(std_error, 4) AS std_error, 'ok' AS status FROM fit")
def fit_lag(spark, sf_dir):
    wide, types = _wide(spark, sf_dir)
    x, names = models.design(models.zscore(wide, "value", ["mz"], "z"), types)
    return models.fit_lag(x, ["mz", "sample_id"], "z", names).select("mz", "sample_id", "n", "term", *_r("estimate", "std_error", digits=4), "status")


def _samples(wide):
    return wide.select("sample_id").distinct().withColumn("dose", F.expr("cast(substring(sample_id, 2) as double)"))


@query()
def two_level_association(spark, sf_dir):
    wide, types = _wide(spark, sf_dir)
    return jobs.two_level_association(wide, types, _samples(wide), ["dose"], "lm").select("mz", "celltype", "term", *_r("estimate", "fdr", digits=4), "status")


@query(_lag_sql() + """,
s AS (SELECT mz, term AS celltype, estimate AS y, CAST(substring(sample_id, 2) AS DOUBLE) AS x, 1 / (std_error * std_error * n) AS w FROM fit),
m AS (SELECT mz, celltype, count(*) AS n, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM s GROUP BY ALL),
b AS (SELECT s.mz, s.celltype, any_value(m.n) AS n, any_value(mx) AS mx, any_value(my) AS my, sum(w * (x - mx) * (y - my)) / nullif(sum(w * (x - mx) ** 2), 0) AS b FROM s JOIN m ON m.mz = s.mz AND m.celltype = s.celltype GROUP BY s.mz, s.celltype)
SELECT mz, celltype, '(Intercept)' AS term, CASE WHEN n > 2 THEN round(my - b * mx, 3) END AS estimate, n > 2 AS ok FROM b UNION ALL SELECT mz, celltype, 'dose', CASE WHEN n > 2 THEN round(b, 3) END, n > 2 FROM b WHERE n > 1""")
def two_level_association_lag(spark, sf_dir):
    """The lag model at the first level, the doses of samples at the second; a single sample has no dose to tell and too few rows."""
    wide, types = _wide(spark, sf_dir)
    out = jobs.two_level_association(wide, types, _samples(wide), ["dose"], "SAR")
    return out.select("mz", "celltype", "term", *_r("estimate", digits=3), (F.col("status") == "ok").alias("ok"))


def _series_sql(steps: int = 12) -> str:
    """u <- X b + rho W u, step by step; rho W is small in these tables."""
    sql = """,
x AS MATERIALIZED (SELECT g.mz, g.sample_id, g.ims_idx, any_value(rho) AS rho, max(CASE WHEN term = '(Intercept)' THEN estimate END) + max(CASE WHEN term = 't1' THEN estimate END) * any_value(x1) + max(CASE WHEN term = 't2' THEN estimate END) * any_value(x2)
  + max(CASE WHEN term = 't3' THEN estimate END) * any_value(x3) AS xb FROM g JOIN fit ON fit.mz = g.mz AND fit.sample_id = g.sample_id JOIN r ON r.mz = g.mz AND r.sample_id = g.sample_id GROUP BY g.mz, g.sample_id, g.ims_idx),
u0 AS (SELECT mz, sample_id, ims_idx, xb AS u FROM x)"""
    for k in range(steps):
        sql += f""", u{k + 1} AS MATERIALIZED (SELECT x.mz, x.sample_id, x.ims_idx, any_value(xb) + any_value(rho) * coalesce(sum(o.u), 0) AS u FROM x LEFT JOIN e ON e.mz = x.mz AND e.sample_id = x.sample_id AND e.i = x.ims_idx
  LEFT JOIN u{k} o ON o.mz = e.mz AND o.sample_id = e.sample_id AND o.ims_idx = e.j GROUP BY x.mz, x.sample_id, x.ims_idx)"""
    return sql + f" SELECT mz, sample_id, ims_idx, round(u, 4) + 0.0 AS predicted, 'ok' AS status FROM u{steps}"


@query(_lag_sql() + _series_sql())
def predict_lag_everywhere(spark, sf_dir):
    """(I - rho W)^-1 X b of the fitted lag model at every pixel."""
    wide, types = _wide(spark, sf_dir)
    x, names = models.design(models.zscore(wide, "value", ["mz"], "z"), types)
    x = x.select("mz", "sample_id", "ims_idx", "ims_x", "ims_y", "z", *[F.col(f"`{c}`").alias(c) for c in names])
    return models.predict_tc(x, models.fit_lag(x, ["mz", "sample_id"], "z", names), ["mz", "sample_id"], names).select("mz", "sample_id", "ims_idx", (F.round("predicted", 4) + 0.0).alias("predicted"), "status")


@query(with_sql("pixels", "boxes") + """
, o AS (SELECT b.sample_id, cell_idx, ims_idx, cx / 100 AS x, cy / 100 AS y,
  greatest(0, least(cx + half, ims_x * 100 + 100) - greatest(cx - half, ims_x * 100)) * greatest(0, least(cy + half, ims_y * 100 + 100) - greatest(cy - half, ims_y * 100)) / (4 * half * half) AS overlap
  FROM boxes b JOIN pixels p ON p.sample_id = b.sample_id AND abs(cx - ims_x * 100 - 50) < 200 AND abs(cy - ims_y * 100 - 50) < 200 WHERE sqrt((cx - ims_x * 100 - 50) ** 2 + (cy - ims_y * 100 - 50) ** 2) < 200),
c AS (SELECT * FROM o WHERE overlap > 0.000001), far AS (SELECT sample_id, ims_idx FROM c GROUP BY ALL HAVING greatest(max(x) - min(x), max(y) - min(y)) > 4),
s AS (SELECT DISTINCT p.sample_id, ims_x AS x, ims_y AS y FROM pixels p JOIN c ON c.sample_id = p.sample_id AND c.ims_idx = p.ims_idx),
t AS MATERIALIZED (SELECT sample_id, x, min(y) AS y FROM s GROUP BY ALL UNION SELECT sample_id, x, max(y) FROM s GROUP BY ALL),
e AS MATERIALIZED (SELECT a.sample_id, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_ FROM t a JOIN t b ON a.sample_id = b.sample_id AND (a.x <> b.x OR a.y <> b.y) JOIN t d ON d.sample_id = a.sample_id
  GROUP BY ALL HAVING min((b.x - a.x) * (d.y - a.y) - (b.y - a.y) * (d.x - a.x)) >= 0),
h AS (SELECT p.sample_id, p.ims_idx, min((bx - ax) * (ims_y - ay) - (by_ - ay) * (ims_x - ax)) >= 0 AS inside FROM pixels p JOIN e ON e.sample_id = p.sample_id GROUP BY ALL)
SELECT p.sample_id, p.ims_idx, c.cell_idx, round(c.overlap, 9) AS overlap, coalesce(h.inside, false) AS "in_IMC", far.ims_idx IS NOT NULL AS implausible
FROM pixels p LEFT JOIN c ON c.sample_id = p.sample_id AND c.ims_idx = p.ims_idx LEFT JOIN h ON h.sample_id = p.sample_id AND h.ims_idx = p.ims_idx LEFT JOIN far ON far.sample_id = p.sample_id AND far.ims_idx = p.ims_idx""")
def combined_table(spark, sf_dir):
    """The combined pixel-cell table of the library. Overlaps below a millionth are what rounding makes of boxes that touch. An
    overlap is a whole number over 4 half^2, which ends within eight digits or never, so no value lies on a tie of the ninth."""
    from mosaica.operators import joins
    from mosaica.functions import geometry as G

    c = cells(spark, sf_dir)
    px = _positions(spark, sf_dir)
    cent = c.select("sample_id", "cell_idx", G.ring_centroid(F.col("ring")).alias("c")).select("sample_id", "cell_idx", "c.x", "c.y")
    out = jobs.combine(px, joins.cell_pixel_overlap(c, px, 1.0, 1.0, 2.0).where("overlap > 0.000001"), cent, spacing=1.0, project="p")
    return out.select("sample_id", "ims_idx", "cell_idx", *_r("overlap", digits=9), "in_IMC", "implausible")


@query(with_sql("pixels", "boxes", "spectra") + """
, o AS (SELECT b.sample_id, cell_idx, ims_idx, cx / 100 AS x, cy / 100 AS y,
  greatest(0, least(cx + half, ims_x * 100 + 100) - greatest(cx - half, ims_x * 100)) * greatest(0, least(cy + half, ims_y * 100 + 100) - greatest(cy - half, ims_y * 100)) / (4 * half * half) AS overlap
  FROM boxes b JOIN pixels p ON p.sample_id = b.sample_id AND abs(cx - ims_x * 100 - 50) < 200 AND abs(cy - ims_y * 100 - 50) < 200 WHERE sqrt((cx - ims_x * 100 - 50) ** 2 + (cy - ims_y * 100 - 50) ** 2) < 200),
c AS (SELECT * FROM o WHERE overlap > 0.000001),
k AS (SELECT ims_idx, max(intensity) AS marker FROM spectra WHERE ims_idx % 3 <> 0 GROUP BY ims_idx)
SELECT p.sample_id, p.ims_idx, c.cell_idx, round(k.marker, 2) AS marker, 'p' AS project_name FROM pixels p LEFT JOIN c ON c.sample_id = p.sample_id AND c.ims_idx = p.ims_idx LEFT JOIN k ON k.ims_idx = p.ims_idx""")
def combined_table_markers(spark, sf_dir):
    """The combined table with a marker of two thirds of the pixels; the others have none."""
    from mosaica.operators import joins
    from mosaica.functions import geometry as G

    c, px = cells(spark, sf_dir), _positions(spark, sf_dir)
    cent = c.select("sample_id", "cell_idx", G.ring_centroid(F.col("ring")).alias("c")).select("sample_id", "cell_idx", "c.x", "c.y")
    marker = fixture(spark, sf_dir, "spectra").where("ims_idx % 3 <> 0").groupBy("ims_idx").agg(F.max("intensity").alias("marker")).join(px.select("sample_id", "ims_idx"), "ims_idx").withColumnRenamed("ims_idx", "label")
    out = jobs.combine(px, joins.cell_pixel_overlap(c, px, 1.0, 1.0, 2.0).where("overlap > 0.000001"), cent, marker, project="p")
    return out.select("sample_id", "ims_idx", "cell_idx", *_r("marker", digits=2), "project_name")
