"""Queries for scans, filters, aggregations, windows and verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from mosaica.functions import scalars
from mosaica.operators import aggregates as A
from mosaica.operators import joins, lookups, verdicts, windows
from mosaica.plans import jobs
from mosaica.plans.fixtures import fixture, with_sql

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


@query("""SELECT p_partkey, 'p_size' AS "column", 'maximum' AS rule FROM part WHERE p_size > 40 UNION ALL
SELECT p_partkey, 'p_size', 'multipleOf' FROM part WHERE p_size % 2 <> 0 UNION ALL SELECT p_partkey, 'p_brand', 'pattern' FROM part WHERE NOT regexp_matches(p_brand, '[1-3]$')""")
def validate_sheet(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return lookups.validate_sheet(part, {"p_size": {"required": True, "maximum": 40, "multipleOf": 2}, "p_brand": {"pattern": "[1-3]$"}}, "p_partkey")


@query(with_sql("spectra", "peaklist") + " SELECT count(*) AS n, round(sum(intensity), 2) AS total FROM spectra WHERE mz BETWEEN (SELECT min(mz) - 1 FROM peaklist WHERE mz > 1020) AND (SELECT max(mz) + 1 FROM peaklist WHERE mz > 1020)")
def prune_mass_range(spark, sf_dir):
    kept = lookups.prune_mass_range(fixture(spark, sf_dir, "spectra"), fixture(spark, sf_dir, "peaklist").where("mz > 1020"))
    return kept.agg(F.count("*").alias("n"), F.round(F.sum("intensity"), 2).alias("total"))


@query(with_sql("spectra") + " SELECT ims_idx, round(sum(intensity), 2) AS tic, count(*) AS n_features FROM spectra GROUP BY ims_idx")
def tic(spark, sf_dir):
    return A.tic(fixture(spark, sf_dir, "spectra")).select("ims_idx", F.round("tic", 2).alias("tic"), "n_features")


@query(with_sql("spectra", "peaklist") + """
, t AS (SELECT ims_idx, sum(intensity) AS tic, count(*) AS n FROM spectra GROUP BY ims_idx),
a AS (SELECT s.ims_idx, p.mz, s.intensity * t.n / t.tic AS v FROM spectra s JOIN t USING (ims_idx) JOIN peaklist p
  ON p.mz BETWEEN round(s.mz) - 0.5 AND round(s.mz) + 0.5 AND round(abs(s.mz - p.mz), 9) <= 0.02)
SELECT ims_idx, mz, round(max(v), 6) AS value FROM a GROUP BY ims_idx, mz""")
def process_spectra(spark, sf_dir):
    out = jobs.process_spectra(fixture(spark, sf_dir, "spectra"), fixture(spark, sf_dir, "peaklist"), transform=lambda v: v)
    return out.select("ims_idx", "mz", *_r("value"))


@query(with_sql("matches") + """
SELECT sample, round(avg(e), 6) AS mean, round(min(e), 6) AS min, round(max(e), 6) AS max, count(e) AS n, round(quantile_cont(e, 0.05), 6) AS q05, round(quantile_cont(e, 0.25), 6) AS q25,
round(quantile_cont(e, 0.5), 6) AS q50, round(quantile_cont(e, 0.75), 6) AS q75, round(quantile_cont(e, 0.95), 6) AS q95 FROM (SELECT sample, abs(p2x - p1x) AS e FROM matches) GROUP BY sample""")
def error_summary(spark, sf_dir):
    out = A.error_summary(fixture(spark, sf_dir, "matches").withColumn("e", F.abs(F.col("p2x") - F.col("p1x"))), ["sample"], "e")
    return out.select("sample", "n", *_r("mean", "min", "max", "q05", "q25", "q50", "q75", "q95"))


@query(with_sql("matches") + """
, e AS (SELECT sample, abs(p2x - p1x) AS e, NOT is_error AS ok FROM matches)
SELECT sample, count(e) AS n, round(quantile_cont(e, 0.5), 6) AS q50, count(CASE WHEN ok THEN e END) AS masked_n, round(quantile_cont(CASE WHEN ok THEN e END, 0.5), 6) AS masked_q50 FROM e GROUP BY sample""")
def error_summary_masked(spark, sf_dir):
    m = fixture(spark, sf_dir, "matches").withColumn("e", F.abs(F.col("p2x") - F.col("p1x"))).withColumn("ok", ~F.col("is_error"))
    return A.error_summary_masked(m, ["sample"], "e", "ok").select("sample", "n", "masked_n", *_r("q50", "masked_q50"))


@query(with_sql("metrics") + """
, m AS (SELECT median(landmark_error) AS med FROM metrics) SELECT round(any_value(med), 6) AS median, round(1.4826 * median(abs(landmark_error - med)), 6) AS mad FROM metrics, m""")
def mad(spark, sf_dir):
    return A.mad(fixture(spark, sf_dir, "metrics"), "landmark_error").select(*_r("median", "mad"))


@query(with_sql("cell_annotation") + """
SELECT sample_id, celltype, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY sample_id), 6) AS proportion FROM cell_annotation GROUP BY sample_id, celltype""")
def celltype_proportions(spark, sf_dir):
    return A.celltype_proportions(fixture(spark, sf_dir, "cell_annotation")).select("sample_id", "celltype", "n", *_r("proportion"))


@query(with_sql("cell_annotation") + """
SELECT sample_id, cell_idx % 100 AS ims_idx, """ + ", ".join(f"round(sum(CASE WHEN left(celltype, 1) = '{i}' THEN value ELSE 0 END), 2) AS t{i}" for i in range(1, 6)) + """
FROM cell_annotation GROUP BY ALL""")
def to_wide(spark, sf_dir):
    a = fixture(spark, sf_dir, "cell_annotation").select("sample_id", (F.col("cell_idx") % 100).alias("ims_idx"), F.concat(F.lit("t"), F.left("celltype", F.lit(1))).alias("celltype"), "value")
    types = [f"t{i}" for i in range(1, 6)]
    return jobs.wide_table(a, ["sample_id", "ims_idx"], types, F.sum("value")).select("sample_id", "ims_idx", *_r(*types, digits=2))


@query(with_sql("pvalues") + """
, r AS (SELECT *, count(*) OVER (PARTITION BY grp) AS n, rank() OVER (PARTITION BY grp ORDER BY p) + count(*) OVER (PARTITION BY grp, p) - 1 AS k FROM pvalues)
SELECT id, grp, round(min(least(1, p * n / k)) OVER (PARTITION BY grp ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS fdr FROM r""")
def fdr(spark, sf_dir):
    return windows.fdr(fixture(spark, sf_dir, "pvalues"), "p", ["grp"]).select("id", "grp", *_r("fdr"))


@query(with_sql("cell_annotation") + """
SELECT cell_idx, coalesce(v, first_value(v IGNORE NULLS) OVER (PARTITION BY sample_id ORDER BY cell_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(v IGNORE NULLS) OVER (PARTITION BY sample_id ORDER BY cell_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS v
FROM (SELECT sample_id, cell_idx, CASE WHEN cell_idx % 3 = 0 THEN status END AS v FROM cell_annotation)""")
def fill_updown(spark, sf_dir):
    a = fixture(spark, sf_dir, "cell_annotation").select("sample_id", "cell_idx", F.when(F.col("cell_idx") % 3 == 0, F.col("status")).alias("v"))
    return windows.fill_updown(a, ["v"], ["sample_id"], "cell_idx").select("cell_idx", "v")


@query(with_sql("boxes") + """
, o AS (SELECT sample_id, cell_idx % 500 AS ims_idx, cell_idx, half * half AS area, (cell_idx % 10) / 10.0 AS overlap FROM boxes),
t AS (SELECT *, sum(overlap * area) OVER (PARTITION BY sample_id, ims_idx) AS total FROM o)
SELECT sample_id, cell_idx, round(CASE WHEN total > 0 THEN overlap * area / total ELSE 1 END, 6) AS weight, round(CASE WHEN total > 0 THEN area / total END, 6) AS scaling FROM t""")
def pixel_weights(spark, sf_dir):
    b = fixture(spark, sf_dir, "boxes").select("sample_id", (F.col("cell_idx") % 500).alias("ims_idx"), "cell_idx", (F.col("half") * F.col("half")).alias("cell_area"), ((F.col("cell_idx") % 10) / 10).alias("overlap"))
    out = windows.pixel_weights(b.withColumn("filled_area", F.col("overlap") * F.col("cell_area")))
    return out.select("sample_id", "cell_idx", *_r("weight", "scaling"))


@query(with_sql("cell_annotation") + """
, p AS (SELECT sample_id, cell_idx % 300 AS i, count(*) AS c FROM cell_annotation GROUP BY ALL)
SELECT sample_id, count(*) AS n_pixels, CAST(sum(c) AS BIGINT) AS n_cells, round(avg(c), 6) AS mean_cells, round(stddev_samp(c), 6) AS sd_cells, round(median(c), 6) AS median_cells FROM p GROUP BY sample_id""")
def pixel_cell_stats(spark, sf_dir):
    a = fixture(spark, sf_dir, "cell_annotation").withColumn("ims_idx", F.col("cell_idx") % 300)
    return A.pixel_cell_stats(a).select("sample_id", "n_pixels", "n_cells", *_r("mean_cells", "sd_cells", "median_cells"))


@query(with_sql("cell_annotation") + """
SELECT left(celltype, 1) AS type, round(avg(CASE WHEN cell_idx % 7 = 0 THEN 1.0 ELSE 0 END), 6) AS missing FROM cell_annotation GROUP BY 1""")
def missing_fraction(spark, sf_dir):
    a = fixture(spark, sf_dir, "cell_annotation").select(F.left("celltype", F.lit(1)).alias("type"), F.when(F.col("cell_idx") % 7 != 0, F.col("value")).alias("value"))
    return A.missing_fraction(a, ["type"]).select("type", *_r("missing"))


@query(with_sql("cell_annotation") + """
SELECT floor(value / 10000) * 10000 AS bin, sample_id, count(*) AS n FROM cell_annotation GROUP BY ALL""")
def binned_counts(spark, sf_dir):
    return verdicts.binned_counts(fixture(spark, sf_dir, "cell_annotation"), "value", 10000.0, ["sample_id"])


@query(with_sql("metrics") + """
, m AS (SELECT median(landmark_error) AS med FROM metrics), b AS (SELECT any_value(med) + 3 * 1.4826 * median(abs(landmark_error - med)) AS bound FROM metrics, m),
v AS (SELECT sample, n_found / n_expected > 0.1 AND landmark_error < bound AS ims, CASE WHEN landmark_n > 50 THEN landmark_error < 5 END AS lm,
  CASE WHEN region_n > 2 THEN region_error < 5 AND region_dice > 0.7 END AS direct, CASE WHEN region_n > 2 THEN region_error < 5 OR region_dice > 0.7 END AS rg,
  sqrt(shift_x * shift_x + shift_y * shift_y) < 5 AS shift FROM metrics, b),
s AS (SELECT *, CASE WHEN NOT (coalesce(lm, false) OR coalesce(rg, false)) AND lm IS NULL AND rg IS NULL THEN NULL ELSE coalesce(lm, false) OR coalesce(rg, false) END AS step FROM v)
SELECT sample, ims, lm, rg, direct, shift, step, CASE WHEN coalesce((ims AND step AND shift AND step) OR direct, false) THEN true WHEN ims IS NULL OR step IS NULL OR shift IS NULL OR direct IS NULL THEN NULL
ELSE (ims AND step AND shift AND step) OR direct END AS overall FROM s""")
def verdict_table(spark, sf_dir):
    m = A.completeness(fixture(spark, sf_dir, "metrics")).withColumn("median_error", F.col("landmark_error"))
    m = verdicts.verdict_ims(m).withColumnRenamed("keep_ims", "ims")
    n, e, d = F.col("region_n"), F.col("region_error"), F.col("region_dice")
    m = m.withColumns({"lm": verdicts.verdict_landmarks(F.col("landmark_n"), F.col("landmark_error")), "direct": verdicts.verdict_regions(n, e, d, True), "rg": verdicts.verdict_regions(n, e, d, False), "shift": verdicts.verdict_shift(F.col("shift_x"), F.col("shift_y"))})
    m = m.withColumn("step", verdicts.step_verdict([F.col("lm"), F.col("rg")], F.col("lm"), F.col("rg")))
    m = m.withColumn("overall", verdicts.overall_verdict(F.col("ims"), F.col("step"), F.col("shift"), F.col("step"), F.col("direct")))
    return verdicts.verdict_table(m, ["ims", "lm", "rg", "direct", "shift", "step", "overall"])


@query(with_sql("metrics") + """
SELECT sample, name, round(value, 6) AS value FROM (SELECT sample, landmark_error, region_error, region_dice FROM metrics) UNPIVOT INCLUDE NULLS (value FOR name IN (landmark_error, region_error, region_dice))""")
def metrics_long(spark, sf_dir):
    return A.to_long(fixture(spark, sf_dir, "metrics").select("sample", "landmark_error", "region_error", "region_dice"), ["sample"]).select("sample", "name", *_r("value"))


@query(with_sql("metrics") + " SELECT sample, round(landmark_error, 6) AS landmark_error, round(region_dice, 6) AS region_dice FROM metrics")
def assemble_metrics(spark, sf_dir):
    m = fixture(spark, sf_dir, "metrics")
    return joins.assemble_metrics([m.select("sample", F.lit(c).alias("metric"), F.col(c).alias("value")) for c in ("landmark_error", "region_dice")], ["landmark_error", "region_dice"]).select("sample", *_r("landmark_error", "region_dice"))


@query(with_sql("metrics") + """
, m AS (SELECT median(region_error) AS med FROM metrics), b AS (SELECT any_value(med) + 1.4826 * median(abs(region_error - med)) AS bound FROM metrics, m)
SELECT sample, round(region_error, 6) AS region_error FROM metrics, b WHERE region_error > bound""")
def flag_outliers(spark, sf_dir):
    return lookups.flag_outliers(fixture(spark, sf_dir, "metrics"), "region_error").select("sample", *_r("region_error"))


@query(with_sql("metrics") + ", t AS (SELECT quantile_cont(region_dice, 0.9) AS q FROM metrics) SELECT sample FROM metrics, t WHERE region_dice >= q")
def quantile_cut(spark, sf_dir):
    return windows.quantile_cut(fixture(spark, sf_dir, "metrics"), "region_dice", 0.9).select("sample")


@query(with_sql("metrics") + " SELECT sample FROM metrics WHERE region_dice >= 0.9 * (SELECT max(region_dice) FROM metrics)")
def top_fraction(spark, sf_dir):
    return windows.top_fraction(fixture(spark, sf_dir, "metrics"), "region_dice").select("sample")


@query(with_sql("matches") + """
, g AS (SELECT sample, is_error, count(*) AS n_rows, avg(p1x) AS mean FROM matches GROUP BY sample, is_error)
SELECT sample, is_error, n_rows, CASE WHEN n_rows >= (SELECT avg(n_rows) FROM g) THEN round(mean, 6) END AS mean FROM g""")
def guard_min_count(spark, sf_dir):
    """All events; the minimum is the mean group size, which splits the groups at every scale."""
    m, keys = fixture(spark, sf_dir, "matches"), ["sample", "is_error"]
    least = m.groupBy(*keys).count().agg(F.avg("count")).first()[0] or 0  # one row
    return lookups.guard_min_count(m, keys, {"mean": F.round(F.avg("p1x"), 6)}, least)


@query(with_sql("cell_annotation") + """
SELECT sample_id, cell_idx FROM (SELECT *, count(*) OVER (PARTITION BY cell_idx % 400) AS n FROM cell_annotation) WHERE n > 37""")
def drop_rare_types(spark, sf_dir):
    a = fixture(spark, sf_dir, "cell_annotation").withColumn("celltype", F.col("cell_idx") % 400)
    return windows.drop_rare_types(a, 37).select("sample_id", "cell_idx")


@query("""SELECT event_id, CAST(props->>'k' AS DOUBLE) AS value FROM events""")
def json_metrics(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", F.from_json("props", "map<string,string>")["k"].try_cast("double").alias("value"))


@query("""SELECT s_suppkey, round(CASE WHEN s_acctbal = 0 THEN 0 ELSE round(s_acctbal * power(10, 2 - floor(log10(abs(s_acctbal))))) / power(10, 2 - floor(log10(abs(s_acctbal)))) END, 6) AS s3,
CASE WHEN s_acctbal > 0 THEN round(log2(s_acctbal), 6) END AS l2 FROM (SELECT s_suppkey, CAST(s_acctbal AS DOUBLE) AS s_acctbal FROM supplier)""")
def scalar_functions(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", F.col("s_acctbal").cast("double").alias("b"))
    return s.select("s_suppkey", F.round(scalars.signif(F.col("b"), 3), 6).alias("s3"), F.round(scalars.log2_na(F.col("b")), 6).alias("l2"))
