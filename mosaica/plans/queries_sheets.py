"""Queries for lookups, keyed joins, aggregates, windows and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from mosaica.functions import geometry as G
from mosaica.functions import scalars
from mosaica.operators import aggregates as A
from mosaica.operators import graphs, joins, lookups, rasters, verdicts, windows
from mosaica.plans import jobs
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


# ---- sample sheet ----


@query(with_sql("sheet") + """
SELECT 'one' AS what, (SELECT arg_min(coalesce(core_name, ''), seq) FROM sheet WHERE project_name = 'P3') AS value
UNION ALL SELECT 'all', coalesce(core_name, '') FROM sheet WHERE project_name = 'P3'
UNION ALL SELECT 'two', coalesce(imzml_filename, '') FROM sheet WHERE project_name = 'P3' AND reg_type = 'T1'
UNION ALL SELECT 'coords', CASE WHEN trim(coalesce(coords_filename, '')) = '' THEN 'results/' || project_name || '/' || sample_name || '_coords.parquet' ELSE coords_filename END FROM sheet
UNION ALL SELECT DISTINCT 'run', replace(imzml_filename, '.imzML', '') || ' ' || project_name FROM sheet
UNION ALL SELECT 'cores', project_name || ' ' || coalesce(string_agg(DISTINCT core_name, ',' ORDER BY core_name), '') FROM sheet GROUP BY project_name""")
def sheet_lookups(spark, sf_dir):
    s = fixture(spark, sf_dir, "sheet")
    said = lambda df, what, value: df.select(F.lit(what).alias("what"), F.expr(value).alias("value"))
    return windows.union_all([
        said(lookups.lookup(s, "project_name", "P3", "core_name"), "one", "core_name"),
        said(lookups.lookup(s, "project_name", "P3", "core_name", all=True), "all", "core_name"),
        said(lookups.lookup2(s, "project_name", "P3", "reg_type", "T1", "imzml_filename", all=True), "two", "imzml_filename"),
        said(lookups.resolve_coords(s), "coords", "coords_path"),
        said(lookups.distinct_runs(s), "run", "concat(imzml, ' ', project_name)"),
        said(lookups.project_cores(s), "cores", "concat(project_name, ' ', array_join(cores, ','))"),
    ])


@query(with_sql("raster") + ", panel AS (SELECT DISTINCT channel, 'marker' || channel AS name FROM raster) SELECT name, row, col, round(value, 4) AS value FROM raster JOIN panel USING (channel) WHERE name = 'marker2' AND row >= 3 AND row < 15 AND col >= 5")
def select_channels(spark, sf_dir):
    r = fixture(spark, sf_dir, "raster")
    panel = r.select("channel", F.concat(F.lit("marker"), "channel").alias("name")).distinct()
    return lookups.crop(lookups.select_channels(r, panel, ["marker2"]), (3, 15, 5, 1 << 30)).select("name", "row", "col", F.round("value", 4).alias("value"))


@query(with_sql("cell_annotation") + """
, a AS (SELECT sample_id, cell_idx, CASE WHEN cell_idx % 11 <> 0 THEN celltype END AS celltype, CASE WHEN cell_idx % 13 <> 0 THEN value END AS value, status = 'F' AS in_IMC, value > 50000 AS to_keep_reg FROM cell_annotation)
SELECT sample_id, cell_idx FROM a WHERE celltype IS NOT NULL AND in_IMC AND to_keep_reg AND value IS NOT NULL""")
def clean_cells(spark, sf_dir):
    a = fixture(spark, sf_dir, "cell_annotation").select(
        "sample_id", "cell_idx", F.when(F.col("cell_idx") % 11 != 0, F.col("celltype")).alias("celltype"), F.when(F.col("cell_idx") % 13 != 0, F.col("value")).alias("value"),
        (F.col("status") == "F").alias("in_IMC"), (F.col("value") > 50000).alias("to_keep_reg"),
    )
    return lookups.complete_cases(lookups.keep_in_area(lookups.drop_unannotated(a)), ["value"]).select("sample_id", "cell_idx")


@query(with_sql("boxes") + """
, a AS (SELECT *, 4 * half * half / 10000 AS area FROM boxes)
SELECT cell_idx, round(area, 6) AS area, round((cx - half) / 100, 6) AS x0, round((cy + half) / 100, 6) AS y1 FROM a
WHERE area BETWEEN 0.2 AND 0.9 AND cx - half > 0 AND cy - half > 0 AND cx + half < 2400 AND cy + half < 1900 AND area >= 0.35 * (SELECT max(area) FROM a)""")
def region_filters(spark, sf_dir):
    from mosaica.plans.fixtures import cells

    c = cells(spark, sf_dir)
    sized = lookups.drop_border_regions(lookups.filter_region_size(c, 0.2, 0.9), 25.0, 20.0)
    largest = c.select(G.ring_area(F.col("ring")).alias("area")).agg(F.max("area").alias("area"))
    return lookups.drop_small_regions(sized, largest, 0.35).select("cell_idx", *_r("area"), F.round("bbox.x0", 6).alias("x0"), F.round("bbox.y1", 6).alias("y1"))


@query(with_sql("cell_annotation") + """
SELECT ims_idx, '100' || left(celltype, 1) AS name, CAST(count(*) AS DOUBLE) AS value FROM (SELECT cell_idx % 300 AS ims_idx, celltype FROM cell_annotation) GROUP BY ALL""")
def mz_columns(spark, sf_dir):
    a = fixture(spark, sf_dir, "cell_annotation").select((F.col("cell_idx") % 300).alias("ims_idx"), F.concat(F.lit("100"), F.left("celltype", F.lit(1))).alias("name"))
    wide = A.to_wide(a, ["ims_idx"], "name", [f"100{i}" for i in range(1, 6)], F.count(F.lit(1)).cast("double")).withColumn("123", F.lit(1.0)).withColumn("total", F.lit(0.0))
    return A.to_long(wide, ["ims_idx"], lookups.mz_columns(wide)).where("value > 0")


@query(with_sql("metrics") + """
, s AS (SELECT sample, landmark_error AS e, n_found, n_expected, n_found / n_expected AS c FROM metrics)
SELECT sample, round(CASE WHEN e = 0 THEN 0 ELSE round(e * power(10, 2 - floor(log10(abs(e))))) / power(10, 2 - floor(log10(abs(e)))) END, 6) AS "errorQ50", round(round(c * power(10, 2 - floor(log10(c)))) / power(10, 2 - floor(log10(c))), 6) AS completeness FROM s""")
def step_summary(spark, sf_dir):
    m = fixture(spark, sf_dir, "metrics").select("sample", F.col("landmark_error").alias("preIMC_to_preIMS_errorquantile50"), F.col("region_dice").alias("dice_postIMC_to_preIMC"), F.col("n_found").alias("n_found_preIMC_to_preIMS"), F.col("n_expected").alias("n_expected_preIMC_preIMS"))
    return verdicts.step_summary(m, "preIMC_to_preIMS").select("sample", *_r("errorQ50", "completeness"))


@query(with_sql("metrics") + """
SELECT sample, landmark_error IS NULL OR region_error IS NULL AS errors_missing, region_dice IS NULL AS dice_missing FROM metrics""")
def metric_missing(spark, sf_dir):
    return verdicts.metric_missing(fixture(spark, sf_dir, "metrics"), {"errors": ["landmark_error", "region_error"], "dice": ["region_dice"]})


@query(with_sql("metrics") + """
, l AS (SELECT sample, unnest(['a_to_b_landmark_error', 'a_to_b_regions_dice']) AS metric, unnest([landmark_error, region_dice]) AS value, unnest([landmark_n / 100, region_n / 10]) AS c FROM metrics)
SELECT sample, metric, round(value, 6) AS value, round(least(greatest(c, 0), 1), 6) AS confidence, CASE WHEN metric LIKE '%dice' THEN 'dice' ELSE 'distance' END AS type,
CASE WHEN metric LIKE '%regions%' THEN 'region' ELSE 'landmark' END AS evaluation, 'a_to_b' AS step, round(CASE WHEN metric LIKE '%dice' THEN greatest(value, 0.5) ELSE least(value, 10) END, 6) AS shown FROM l
UNION ALL SELECT sample, 'a_to_b_landmark_n', landmark_n, NULL, 'distance', 'landmark', 'a_to_b', least(landmark_n, 10) FROM metrics
UNION ALL SELECT sample, 'a_to_b_regions_n', region_n, NULL, 'distance', 'region', 'a_to_b', least(region_n, 10) FROM metrics""")
def metric_overview(spark, sf_dir):
    m = fixture(spark, sf_dir, "metrics").select("sample", F.col("landmark_error").alias("a_to_b_landmark_error"), F.col("region_dice").alias("a_to_b_regions_dice"), F.col("landmark_n").alias("a_to_b_landmark_n"), F.col("region_n").alias("a_to_b_regions_n"))
    names = spark.createDataFrame([("a_to_b_landmark_error", "a_to_b_landmark_n"), ("a_to_b_regions_dice", "a_to_b_regions_n")], "metric string, confidence_metric string")
    out = verdicts.metric_overview(m, [c for c in m.columns if c != "sample"], names)
    return out.select("sample", "metric", *_r("value", "confidence"), "type", "evaluation", "step", *_r("shown"))


@query(with_sql("metrics") + """
, g AS (SELECT * FROM (SELECT unnest([2, 4]) AS max_error), (SELECT unnest([0.4, 0.5]) AS min_dice)), f AS (SELECT sample % 2 AS family, * FROM metrics)
SELECT sample, max_error, CAST(min_dice AS DOUBLE) AS min_dice, landmark_error < max_error AND region_dice > min_dice AS ok FROM f, g WHERE family = 1 AND sample % 3 IN (0, 1)""")
def threshold_settings(spark, sf_dir):
    m = fixture(spark, sf_dir, "metrics").withColumn("family", (F.col("sample") % 2).cast("string")).withColumn("step", (F.col("sample") % 3).cast("string"))
    out = verdicts.with_thresholds(lookups.select_families(m, ["1"], ["0", "1"]), joins.param_grid(spark, max_error=[2, 4], min_dice=[0.4, 0.5]))
    return out.select("sample", "max_error", "min_dice", ((F.col("landmark_error") < F.col("max_error")) & (F.col("region_dice") > F.col("min_dice"))).alias("ok"))


_FIT = with_sql("pvalues") + """
, f AS (SELECT grp AS mz, 'T' || id % 5 AS celltype, CASE WHEN id % 2 = 0 THEN '(Intercept)' ELSE 'dose' END AS term, avg(id % 17 - 8) AS estimate, min(p) AS p_value FROM pvalues GROUP BY ALL),
r AS (SELECT *, count(*) OVER (PARTITION BY term) AS n, rank() OVER (PARTITION BY term ORDER BY p_value) + count(*) OVER (PARTITION BY term, p_value) - 1 AS k FROM f),
q AS (SELECT mz, celltype, term, estimate, p_value, min(least(1, p_value * n / k)) OVER (PARTITION BY term ORDER BY p_value DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fdr FROM r)"""


def _fit(spark, sf_dir):
    f = fixture(spark, sf_dir, "pvalues").select(F.col("grp").alias("mz"), F.concat(F.lit("T"), F.col("id") % 5).alias("celltype"), F.when(F.col("id") % 2 == 0, "(Intercept)").otherwise("dose").alias("term"), (F.col("id") % 17 - 8).alias("e"), "p")
    return f.groupBy("mz", "celltype", "term").agg(F.avg("e").alias("estimate"), F.min("p").alias("p_value")).withColumn("std_error", F.abs("estimate") / 2)


@query(_FIT + """
, s AS (SELECT mz, celltype, term, p_value AS v, fdr AS w FROM q)
SELECT mz, celltype, term, round(round(v * power(10, 2 - floor(log10(v)))) / power(10, 2 - floor(log10(v))), 6) AS p_value, round(round(w * power(10, 2 - floor(log10(w)))) / power(10, 2 - floor(log10(w))), 6) AS fdr FROM s""")
def association_table(spark, sf_dir):
    return verdicts.association_table(_fit(spark, sf_dir)).select("mz", "celltype", "term", *_r("p_value", "fdr"))


@query(_FIT + "SELECT mz, " + ", ".join(f"round(max(CASE WHEN celltype = 'T{i}' THEN estimate END), 6) AS t{i}" for i in range(5)) + " FROM q WHERE term = '(Intercept)' GROUP BY mz")
def association_matrix(spark, sf_dir):
    types = [f"T{i}" for i in range(5)]
    fit = windows.fdr(_fit(spark, sf_dir), "p_value", ["term"], "fdr")
    return verdicts.association_matrix(fit, "estimate", types).select("mz", *[F.round(t, 6).alias(t.lower()) for t in types])


@query(_FIT + "SELECT mz, celltype, round(estimate, 6) AS estimate, round(-log10(fdr), 6) AS neg_log10_fdr, fdr < 0.2 AS significant, CASE WHEN fdr < 0.2 THEN celltype || ' ' || mz END AS label FROM q WHERE term = 'dose'")
def volcano(spark, sf_dir):
    fit = windows.fdr(_fit(spark, sf_dir), "p_value", ["term"], "fdr")
    return verdicts.volcano(fit, "dose", 0.2).select("mz", "celltype", *_r("estimate", "neg_log10_fdr"), "significant", "label")


# ---- keyed joins and jobs ----


@query(with_sql("grid_pixels") + """
, p AS (SELECT ims_idx, coalesce(CASE WHEN ims_idx % 2 = 0 THEN row * -3.0 END, (row + 2) * -3.0 - 0) AS px, coalesce(CASE WHEN ims_idx % 2 = 0 THEN col * -3.0 END, (col + 1) * -3.0) AS py, row, col FROM grid_pixels),
c AS (SELECT corr(col, px) < -0.99 AND corr(row, py) < -0.99 AS s FROM p)
SELECT ims_idx, round(CASE WHEN s THEN py ELSE px END, 6) AS phys_x, round(CASE WHEN s THEN px ELSE py END, 6) AS phys_y FROM p, c""")
def peak_table(spark, sf_dir):
    g = fixture(spark, sf_dir, "grid_pixels")
    even = F.col("ims_idx") % 2 == 0
    coords = g.select(F.col("col").alias("x_orig"), F.col("row").alias("y_orig"), (-F.col("row") - 2).alias("x_pad"), (-F.col("col") - 1).alias("y_pad"), F.when(even, F.col("row") * -3.0).alias("x_um"), F.when(even, F.col("col") * -3.0).alias("y_um"))
    return jobs.peak_table(g.select("ims_idx", F.col("col").alias("x"), F.col("row").alias("y")), coords, 3.0).select("ims_idx", *_r("phys_x", "phys_y"))


_CELLS = with_sql("boxes", "cell_annotation", "pixels") + """
, o AS (SELECT b.sample_id, b.cell_idx, b.cell_idx % 500 + 500 * CAST(right(b.sample_id, 1) AS INT) AS ims_idx, (b.cell_idx % 10) / 10.0 AS overlap, 4 * half * half / 10000 AS cell_area, cx / 100 AS x, cy / 100 AS y FROM boxes b)"""


def _overlaps(spark, sf_dir):
    b = fixture(spark, sf_dir, "boxes")
    o = b.select("sample_id", "cell_idx", (F.col("cell_idx") % 500 + 500 * F.right("sample_id", F.lit(1)).cast("int")).alias("ims_idx"), (F.col("cell_idx") % 10 / 10).alias("overlap"), (4 * F.col("half") * F.col("half") / 10000).alias("cell_area"))
    return o, b.select("sample_id", "cell_idx", (F.col("cx") / 100).alias("x"), (F.col("cy") / 100).alias("y"))


@query(_CELLS + """
SELECT o.sample_id, o.cell_idx, o.ims_idx, round(o.x, 6) AS cell_x, a.celltype, p.ims_x FROM o JOIN cell_annotation a ON a.sample_id = o.sample_id AND a.cell_idx = o.cell_idx JOIN pixels p ON p.sample_id = o.sample_id AND p.ims_idx = o.ims_idx WHERE a.status = 'F'""")
def combine_annotated(spark, sf_dir):
    o, c = _overlaps(spark, sf_dir)
    ann = fixture(spark, sf_dir, "cell_annotation").where("status = 'F'")
    return jobs.combine_annotated(fixture(spark, sf_dir, "pixels"), o, c, ann).select("sample_id", "cell_idx", "ims_idx", *_r("cell_x"), "celltype", "ims_x")


@query(_CELLS + """
, k AS (SELECT sample_id, max(value) AS dose FROM cell_annotation WHERE cell_idx % 3 = 0 GROUP BY sample_id)
SELECT o.sample_id, o.cell_idx, a.celltype, round(dose, 4) AS dose FROM o JOIN cell_annotation a ON a.sample_id = o.sample_id AND a.cell_idx = o.cell_idx JOIN k ON k.sample_id = o.sample_id WHERE a.status <> 'P'""")
def prepare(spark, sf_dir):
    o, _ = _overlaps(spark, sf_dir)
    ann = fixture(spark, sf_dir, "cell_annotation")
    top = ann.where("cell_idx % 3 = 0").groupBy("sample_id").agg(F.max("value").alias("top"))
    ann = ann.join(top, "sample_id").select("sample_id", "cell_idx", F.when(F.col("status") != "P", F.col("celltype")).alias("celltype"), F.when(F.col("cell_idx") % 3 == 0, F.col("top")).alias("dose"))
    return jobs.prepare(o, ann, ["dose"]).select("sample_id", "cell_idx", "celltype", F.round("dose", 4).alias("dose"))


@query(_CELLS + """
, f AS (SELECT o.sample_id, o.cell_idx, o.ims_idx, CASE WHEN cell_idx % 10 = 0 THEN cell_idx ELSE cell_idx % 10 END AS celltype, cell_area, overlap * cell_area AS filled FROM o),
t AS (SELECT *, sum(filled) OVER (PARTITION BY sample_id, ims_idx) AS total, count(*) OVER (PARTITION BY celltype) AS n FROM f)
SELECT sample_id, cell_idx, round(filled, 6) AS filled_area, round(filled / 0.81, 6) AS filled_share, round(CASE WHEN total > 0 THEN filled / total ELSE 1 END, 6) AS weight FROM t WHERE n > 2""")
def pixel_statistics(spark, sf_dir):
    o, _ = _overlaps(spark, sf_dir)
    t = o.withColumn("celltype", F.when(F.col("cell_idx") % 10 == 0, F.col("cell_idx")).otherwise(F.col("cell_idx") % 10)).withColumn("pixel_area", F.lit(0.81))
    return jobs.pixel_statistics(t).select("sample_id", "cell_idx", *_r("filled_area", "filled_share", "weight"))


@query(_CELLS + """
, n AS (SELECT sample_id, ims_idx, count(*) AS n, sum(overlap * cell_area) AS filled FROM o GROUP BY ALL), m AS (SELECT cell_idx, count(*) AS k FROM (SELECT cell_idx % 5000 AS cell_idx FROM o) GROUP BY 1)
SELECT o.sample_id, o.cell_idx, n.n AS n_cells, row_number() OVER (PARTITION BY o.sample_id, o.ims_idx ORDER BY o.cell_idx) - 1 AS idx, round(n.filled, 6) AS filled, round(o.cell_area / sum(o.cell_area) OVER (PARTITION BY o.sample_id, o.ims_idx), 6) AS share
FROM o JOIN n ON n.sample_id = o.sample_id AND n.ims_idx = o.ims_idx""")
def cells_per_pixel(spark, sf_dir):
    o, _ = _overlaps(spark, sf_dir)
    t = windows.share(windows.index_rows(windows.cells_per_pixel(o), ["sample_id", "ims_idx"], "cell_idx"), "cell_area", ["sample_id", "ims_idx"])
    return t.join(A.filled_area(o), ["sample_id", "ims_idx"]).select("sample_id", "cell_idx", "n_cells", "idx", *_r("filled", "share"))


@query(_CELLS + """
, d AS (SELECT sample_id, cell_idx % 3000 AS cell_idx, ims_idx FROM o), n AS (SELECT sample_id, cell_idx, count(*) AS n FROM d GROUP BY ALL)
SELECT d.sample_id, d.cell_idx, d.ims_idx, count(*) AS n FROM d JOIN n ON n.sample_id = d.sample_id AND n.cell_idx = d.cell_idx WHERE n.n > 1 GROUP BY ALL""")
def multi_pixel_cells(spark, sf_dir):
    o, _ = _overlaps(spark, sf_dir)
    return A.multi_pixel_cells(o.withColumn("cell_idx", F.col("cell_idx") % 3000)).groupBy("sample_id", "cell_idx", "ims_idx").agg(F.count("*").alias("n"))


@query(with_sql("boxes") + """
, g AS (SELECT sample_id, cell_idx % 2000 AS ims_idx, max(cx) - min(cx) AS dx, max(cy) - min(cy) AS dy FROM boxes GROUP BY ALL)
SELECT sample_id, ims_idx, round(dx, 4) AS dx, round(dy, 4) AS dy, sqrt(dx * dx + dy * dy) > 1600 AS diagonal FROM g WHERE greatest(dx, dy) > 1200""")
def position_outliers(spark, sf_dir):
    b = fixture(spark, sf_dir, "boxes").select("sample_id", (F.col("cell_idx") % 2000).alias("ims_idx"), F.col("cx").alias("x"), F.col("cy").alias("y"))
    far = A.position_outliers(b, 400.0, "diagonal").select("sample_id", "ims_idx", F.lit(True).alias("_d"))
    return A.position_outliers(b, 300.0).join(far, ["sample_id", "ims_idx"], "left").select("sample_id", "ims_idx", F.round("dx", 4).alias("dx"), F.round("dy", 4).alias("dy"), F.coalesce("_d", F.lit(False)).alias("diagonal"))


@query(with_sql("pixels") + """
, p AS (SELECT sample_id, CAST(ims_x AS DOUBLE) AS ims_x, CAST(ims_y AS DOUBLE) AS ims_y, CASE WHEN right(sample_id, 1) IN ('1', '3') THEN ims_y + ims_idx % 3 ELSE 20 - ims_x + ims_idx % 2 END AS x, CASE WHEN right(sample_id, 1) IN ('1', '3') THEN ims_x * 2 ELSE 30 - ims_y END AS y FROM pixels),
c AS (SELECT sample_id, corr(ims_x, x) AS xx, corr(ims_y, y) AS yy, corr(ims_y, x) AS yx, corr(ims_x, y) AS xy FROM p GROUP BY sample_id),
s AS (SELECT sample_id, CASE WHEN xx < 0.5 OR yy < 0.5 THEN abs((xx + yy) / 2) ELSE (xx + yy) / 2 END AS straight, CASE WHEN yx < 0.5 OR xy < 0.5 THEN abs((yx + xy) / 2) ELSE (yx + xy) / 2 END AS exchanged FROM c)
SELECT sample_id, round(straight, 5) AS straight, round(exchanged, 5) AS exchanged, CASE WHEN straight > 0.9 AND exchanged <= 0.9 THEN false WHEN exchanged > 0.9 AND straight <= 0.9 THEN true END AS flipped FROM s""")
def axis_flipped(spark, sf_dir):
    turned = F.right("sample_id", F.lit(1)).isin("1", "3")
    x = F.when(turned, F.col("ims_y") + F.col("ims_idx") % 3).otherwise(20 - F.col("ims_x") + F.col("ims_idx") % 2)
    p = fixture(spark, sf_dir, "pixels").withColumns({"x": x, "y": F.when(turned, F.col("ims_x") * 2).otherwise(30 - F.col("ims_y"))})
    return A.axis_flipped(p, ["sample_id"]).select("sample_id", *_r("straight", "exchanged", digits=5), "flipped")


@query(with_sql("spectra") + """
, m AS (SELECT floor(mz) AS mz, ims_idx % 10 AS grp, avg(intensity) AS mean, sum(intensity) AS total, stddev_samp(intensity) AS sd FROM spectra GROUP BY ALL)
SELECT s.ims_idx, CAST(floor(s.mz) AS BIGINT) AS mz, round(sum((s.intensity - m.mean) / m.sd), 5) AS z, round(any_value(m.mean), 3) AS mean, round(any_value(m.total), 2) AS total FROM spectra s JOIN m ON floor(s.mz) = m.mz AND s.ims_idx % 10 = m.grp GROUP BY 1, 2""")
def standardise(spark, sf_dir):
    s = fixture(spark, sf_dir, "spectra").select("ims_idx", F.floor("mz").alias("mz"), (F.col("ims_idx") % 10).alias("grp"), F.col("intensity").alias("value"))
    z = A.standardise(s, "value", ["mz", "grp"]).groupBy("ims_idx", "mz", "grp").agg(F.sum("z").alias("z"))
    return z.join(A.mean_intensity(s, ["mz", "grp"]), ["mz", "grp"]).join(A.pixel_total(s, ["mz", "grp"]), ["mz", "grp"]).select("ims_idx", "mz", *_r("z", digits=5), F.round("mean", 3).alias("mean"), F.round("total", 2).alias("total"))


@query(with_sql("matches") + """
, f AS (SELECT id % 50 AS mz, 'T' || sample AS celltype, avg(p1x) AS estimate FROM matches GROUP BY ALL), m AS (SELECT id % 50 AS mz, avg(CASE WHEN is_error THEN 1.0 ELSE 0 END) AS missing FROM matches GROUP BY 1)
SELECT celltype, round(corr(missing, estimate), 6) AS correlation FROM f JOIN m USING (mz) GROUP BY celltype""")
def missing_vs_estimate(spark, sf_dir):
    m = fixture(spark, sf_dir, "matches").withColumn("mz", F.col("id") % 50).withColumn("value", F.when(~F.col("is_error"), F.col("p1x")))
    fit = m.groupBy("mz", F.concat(F.lit("T"), "sample").alias("celltype")).agg(F.avg("p1x").alias("estimate"))
    return A.missing_vs_estimate(fit, A.missing_fraction(m, ["mz"])).select("celltype", *_r("correlation"))


@query("""
WITH p AS (SELECT CASE WHEN event_type = 'error' THEN 'edge' ELSE 'centre' END AS population, CAST(floor(value) % 256 AS INT) AS value FROM events), n AS (SELECT population, count(*) AS total FROM p GROUP BY 1),
e AS (SELECT t, sum(CASE WHEN population = 'edge' AND value > t OR population = 'centre' AND value <= t - 1 THEN 1.0 / total ELSE 0 END) AS error FROM p JOIN n USING (population), (SELECT unnest(range(255)) AS t) GROUP BY t),
b AS (SELECT t, error FROM e ORDER BY round(error, 12), t LIMIT 1)
SELECT CASE WHEN error < 1 THEN CAST(t AS INT) END AS threshold, round(error, 6) AS error FROM b""")
def two_population_threshold(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.when(F.col("event_type") == "error", "edge").otherwise("centre").alias("population"), (F.floor("value") % 256).cast("int").alias("value"))
    return A.two_population_threshold(e).select("threshold", *_r("error"))


@query("SELECT c_nationkey AS sample, max(c_nationkey * 2) AS c_nation2 FROM customer GROUP BY c_nationkey")
def sample_constant_columns(spark, sf_dir):
    """The columns that are constant within every sample, with their values."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_nationkey", "c_mktsegment", (F.col("c_nationkey") * 2).alias("c_nation2"))
    return c.groupBy(F.col("c_nationkey").alias("sample")).agg(*[F.max(k).alias(k) for k in A.sample_constant_columns(c, "c_nationkey")])


@query("""
WITH a AS (SELECT c_mktsegment AS name, c_nationkey AS sample_id FROM customer), b AS (SELECT replace(c_mktsegment, 'BUILDING', 'TOWER') AS name, c_nationkey + 3 AS sample_id FROM customer)
SELECT 'mismatch' AS what, name AS value, count(*) AS n FROM (SELECT name FROM a EXCEPT ALL SELECT name FROM b) GROUP BY name UNION ALL SELECT 'mismatch', name, count(*) FROM (SELECT name FROM b EXCEPT ALL SELECT name FROM a) GROUP BY name
UNION ALL SELECT 'common', CAST(sample_id AS VARCHAR), 1 FROM (SELECT sample_id FROM a INTERSECT SELECT sample_id FROM b)
UNION ALL SELECT 'exists ' || t, CAST(EXISTS (SELECT 1 FROM a WHERE name = t) AS VARCHAR), 1 FROM (SELECT unnest(['BUILDING', 'TOWER']) AS t)
UNION ALL SELECT 'pixel', name || sample_id, 1 FROM (SELECT DISTINCT name, sample_id FROM a)""")
def set_operations(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_mktsegment").alias("name"), F.col("c_nationkey").alias("sample_id"))
    b = c.select(F.regexp_replace("name", "BUILDING", "TOWER").alias("name"), (F.col("sample_id") + 3).alias("sample_id"))
    one = F.lit(1).cast("long").alias("n")
    return windows.union_all([
        windows.name_mismatch(c, b).groupBy(F.lit("mismatch").alias("what"), F.col("name").alias("value")).agg(F.count("*").alias("n")),
        windows.common_samples(c, b).select(F.lit("common").alias("what"), F.col("sample_id").cast("string").alias("value"), one),
        windows.presence(c.withColumnRenamed("name", "type"), ["BUILDING", "TOWER"]).select(F.concat(F.lit("exists "), "type").alias("what"), F.col("exists").cast("string").alias("value"), one),
        windows.distinct_pixels(c, ["name", "sample_id"]).select(F.lit("pixel").alias("what"), F.concat("name", "sample_id").alias("value"), one),
    ])


@query("""
WITH c AS (SELECT s_nationkey AS grp, s_suppkey AS candidate, CAST(s_suppkey % 7 AS DOUBLE) / 7 AS coverage, CAST(s_suppkey % 11 AS DOUBLE) AS n_matches, abs(s_acctbal) AS weighted_distance FROM supplier),
k AS (SELECT *, max(q) OVER () AS cut FROM (SELECT *, quantile_cont(coverage, 0.995) OVER (PARTITION BY grp) AS q FROM c)),
s AS (SELECT *, min(coverage) OVER w AS c0, max(coverage) OVER w AS c1, min(n_matches) OVER w AS n0, max(n_matches) OVER w AS n1, min(weighted_distance) OVER w AS d0, max(weighted_distance) OVER w AS d1 FROM k WHERE coverage >= q WINDOW w AS (PARTITION BY grp)),
r AS (SELECT *, CASE WHEN c1 > c0 THEN (coverage - c0) / (c1 - c0) ELSE 1 END + CASE WHEN n1 > n0 THEN (n_matches - n0) / (n1 - n0) ELSE 1 END + CASE WHEN d1 > d0 THEN 1 - (weighted_distance - d0) / (d1 - d0) ELSE 1 END AS score FROM s)
SELECT grp, candidate, round(score, 6) AS score, coverage < 0.95 AS identity FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, candidate) AS k FROM r) WHERE k = 1""")
def composite_best(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    c = s.select(F.col("s_nationkey").alias("grp"), F.col("s_suppkey").alias("candidate"), ((F.col("s_suppkey") % 7).cast("double") / 7).alias("coverage"), (F.col("s_suppkey") % 11).cast("double").alias("n_matches"), F.abs("s_acctbal").alias("weighted_distance"))
    return windows.composite_best(c, ["grp"]).select("grp", "candidate", *_r("score"), "identity")


@query(with_sql("metrics") + " SELECT sample FROM metrics ORDER BY region_dice, sample LIMIT 9")
def top_n(spark, sf_dir):
    """The nine least scores: a top-k report."""
    return windows.top_n(fixture(spark, sf_dir, "metrics").withColumn("s", F.struct("region_dice", "sample")), "s", 9).select("sample")


@query("""
WITH c AS (SELECT s_suppkey % 10 AS sample, 'R' || s_suppkey % 3 AS region, s_nationkey AS score FROM supplier), k AS (SELECT sample, region, sum(score) AS score FROM c GROUP BY ALL)
SELECT sample, region, coalesce(score, 0) AS score FROM (SELECT DISTINCT a.sample, b.region FROM k a CROSS JOIN k b) g LEFT JOIN k USING (sample, region)""")
def complete(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select((F.col("s_suppkey") % 10).alias("sample"), F.concat(F.lit("R"), F.col("s_suppkey") % 3).alias("region"), F.col("s_nationkey").cast("long").alias("score"))
    return joins.complete(s.groupBy("sample", "region").agg(F.sum("score").alias("score")), "sample", "region", {"score": 0})


@query("""
WITH c AS (SELECT DISTINCT s_nationkey AS sample, 'A' || s_suppkey % 4 AS region FROM supplier), m AS (SELECT DISTINCT s_nationkey AS sample, 'A' || s_suppkey % 4 AS region, 'B' || s_suppkey % 3 AS other FROM supplier WHERE s_suppkey % 5 <> 0),
n AS (SELECT sample, count(DISTINCT region) AS n FROM c GROUP BY sample), k AS (SELECT sample, count(DISTINCT other) AS m, min(other) AS o FROM m GROUP BY sample)
SELECT c.sample, c.region, CASE WHEN n = 1 AND m = 1 THEN o ELSE m.other END AS other FROM c LEFT JOIN m ON m.sample = c.sample AND m.region = c.region JOIN n ON n.sample = c.sample LEFT JOIN k ON k.sample = c.sample""")
def join_region_match(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    region = F.concat(F.lit("A"), F.col("s_suppkey") % 4).alias("region")
    cores = s.select(F.col("s_nationkey").alias("sample"), region).distinct()
    match = s.where("s_suppkey % 5 <> 0").select(F.col("s_nationkey").alias("sample"), region, F.concat(F.lit("B"), F.col("s_suppkey") % 3).alias("other")).distinct()
    return joins.join_region_match(cores, match).select("sample", "region", "other")


@query(with_sql("metrics") + " SELECT s_suppkey AS sample, s_name AS file, round(region_dice, 6) AS region_dice FROM metrics RIGHT JOIN supplier ON sample = s_suppkey")
def join_reports(spark, sf_dir):
    files = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").cast("int").alias("sample"), F.col("s_name").alias("file"))
    return joins.join_reports(fixture(spark, sf_dir, "metrics"), files).select("sample", "file", *_r("region_dice"))


@query(with_sql("metrics") + """
SELECT sample, CASE WHEN region_dice BETWEEN 0.4 AND 0.6 THEN round(landmark_error, 6) END AS landmark_error, CASE WHEN region_dice BETWEEN 0.4 AND 0.6 THEN round(region_error, 6) END AS region_error FROM metrics""")
def tissue_guard(spark, sf_dir):
    return rasters.tissue_guard(fixture(spark, sf_dir, "metrics"), "region_dice", 0.4, 0.6, ["landmark_error", "region_error"]).select("sample", *_r("landmark_error", "region_error"))


@query(with_sql("matches") + """
SELECT id, regexp_replace('S' || sample || '_x.csv', '_x.csv$', '') AS stripped, CAST(p1y AS INT) || '_' || sample AS key, CAST(trunc(p1x * 5 / 2) AS INT) AS px, round(sqrt((p1x - p2x) ** 2 + (p1y - p2y) ** 2) * 0.5, 6) AS d,
round(degrees(atan2((p1x - 1) * (p2y - 2) - (p1y - 2) * (p2x - 1), (p1x - 1) * (p2x - 1) + (p1y - 2) * (p2y - 2))), 4) AS angle FROM matches""")
def coordinate_functions(spark, sf_dir):
    m = fixture(spark, sf_dir, "matches")
    c = [F.col(n) for n in ("p1x", "p1y", "p2x", "p2y")]
    key = scalars.pixel_key(F.col("p1y").cast("int").cast("string"), F.col("sample").cast("string"))
    return m.select(
        "id", scalars.strip_name(F.concat(F.lit("S"), "sample", F.lit("_x.csv")), "_x.csv$").alias("stripped"), key.alias("key"), scalars.to_px(c[0], 5.0, 2.0).alias("px"),
        F.round(scalars.distance(*c, 0.5), 6).alias("d"), F.round(scalars.angle_deg(c[0], c[1], F.lit(1.0), F.lit(2.0), c[2], c[3]), 4).alias("angle"),
    )


@query("SELECT a.c_mktsegment || ':' || b.c_mktsegment AS pair FROM (SELECT DISTINCT c_mktsegment FROM customer) a JOIN (SELECT DISTINCT c_mktsegment FROM customer) b ON a.c_mktsegment < b.c_mktsegment")
def pair_names(spark, sf_dir):
    return graphs.pair_names(spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_mktsegment").alias("name")))
