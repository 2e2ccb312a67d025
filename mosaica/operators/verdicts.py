"""Registration quality: metrics per sample and step, verdicts, report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mosaica.functions.scalars import clamp_for_display, classify_metric, confidence, signif
from mosaica.operators import aggregates as A
from mosaica.operators import graphs, joins, transforms
from mosaica.operators.lookups import select_step
from mosaica.operators.windows import fdr, ssim

# Fixed thresholds of the verdicts.
THRESHOLDS = {"min_completeness": 0.1, "min_landmarks": 50.0, "min_regions": 2.0, "max_error": 5.0, "min_dice": 0.7, "k_mad": 3.0}


def landmark_metrics(matches: DataFrame, keys: list[str], threshold: float = 5.0, least: int = 5) -> DataFrame:
    """Error summary of inliers on tissue, shift and matrix of the robust affine; null with fewer than `least` inliers.

    matches: keys, id, p1x, p1y, p2x, p2y, on_tissue.
    """
    fit = transforms.fit_affine_robust(matches, keys, threshold, least=least)
    res = transforms.residuals(matches.where("on_tissue"), fit.where("m is not null"), keys).where(F.col("residual") <= threshold)
    errors = A.error_summary(res.withColumn("error", F.hypot(F.col("p1x") - F.col("p2x"), F.col("p1y") - F.col("p2y"))), keys, "error")
    return fit.select(*keys, F.col("n").alias("n_matches"), "n_inliers").join(errors, keys, "left").join(transforms.affine_metrics(fit, keys), keys, "left")


def region_metrics(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Error and Dice summary of one-to-one region pairs (keys, d, dice) with a Dice above 0."""
    kept = pairs.where("dice > 0")
    d = A.error_summary(kept, keys, "dice")
    return A.error_summary(kept, keys, "d").join(d.select(*keys, *[F.col(c).alias(f"dice_{c}") for c in d.columns if c not in keys]), keys)


def mask_metrics(m1: DataFrame, m2: DataFrame, spacing: float) -> DataFrame:
    """Dice, areas over spacing squared, and distance of the centroids of two masks (row, col)."""
    p = lambda m, n: m.agg((F.count("*") / spacing**2).alias(f"area{n}"), F.avg("row").alias(f"r{n}"), F.avg("col").alias(f"c{n}"))
    return A.dice(m1, m2).crossJoin(p(m1, 1)).crossJoin(p(m2, 2)).select("dice", "area1", "area2", F.hypot(F.col("r1") - F.col("r2"), F.col("c1") - F.col("c2")).alias("centroid_distance"))


def mark_metrics(marks: DataFrame, pixels: DataFrame, max_dist: float) -> DataFrame:
    """Distance summary of marks (id, x, y, in_mask) to their nearest pixel, overall and in the mask, with found and total counts."""
    near = joins.knn_join(marks, pixels, 1, max_dist=max_dist).join(joins.unbroadcast(marks.select("id", "in_mask")), "id")
    return A.error_summary_masked(near, [], "d", "in_mask").crossJoin(marks.agg(F.count("*").alias("n_total")))


def accepted_marks(marks: DataFrame, pixels: DataFrame, step: float) -> DataFrame:
    """Mutual nearest pairs nearer than half a step: mean error and count."""
    return joins.mutual_nn(marks, pixels, step / 2).where(F.col("d") < step / 2).agg(F.avg("d").alias("mean_error"), F.count("*").alias("n"))


def frame_metrics(displacement: DataFrame, before: DataFrame, after: DataFrame, target: DataFrame) -> DataFrame:
    """Displacement summary, and share of the target covered before and after a transform."""
    named = lambda df, n: df.withColumnRenamed("covered", n)
    return A.error_summary(displacement, [], "displacement").crossJoin(named(A.cover_fraction(target, before), "covered_before")).crossJoin(named(A.cover_fraction(target, after), "covered_after"))


def similarity_metrics(img1: DataFrame, img2: DataFrame, data_range: float = 1.0) -> DataFrame:
    """Errors, mutual information and structural similarity of two images."""
    return A.image_similarity(img1, img2).crossJoin(ssim(img1, img2, data_range))


def verdict_ims(df: DataFrame, t: dict = THRESHOLDS) -> DataFrame:
    """Completeness above its threshold and median error below median + k * MAD over samples."""
    bound = F.broadcast(A.mad(df, "median_error").select((F.col("median") + t["k_mad"] * F.col("mad")).alias("_bound")))  # one row
    return df.crossJoin(bound).withColumn("keep_ims", (F.col("completeness") > t["min_completeness"]) & (F.col("median_error") < F.col("_bound"))).drop("_bound")


def verdict_landmarks(n: Column, error: Column, t: dict = THRESHOLDS) -> Column:
    """Error below its threshold; null with too few landmarks."""
    return F.when(n > t["min_landmarks"], error < t["max_error"])


def verdict_regions(n: Column, error: Column, dice: Column, both: bool, t: dict = THRESHOLDS) -> Column:
    """both: error and Dice must hold (the step postIMC to postIMS), else either is enough."""
    e, d = error < t["max_error"], dice > t["min_dice"]
    return F.when(n > t["min_regions"], (e & d) if both else (e | d))


def verdict_shift(dx: Column, dy: Column, t: dict = THRESHOLDS) -> Column:
    """Shift shorter than the largest error."""
    return F.hypot(dx, dy) < t["max_error"]


def thresholds_table(spark: SparkSession, settings: list[dict]) -> DataFrame:
    """A short table of settings, numbered in the order given."""
    return spark.createDataFrame([{"setting": i, **{k: float(v) for k, v in s.items()}} for i, s in enumerate(settings)])


def with_thresholds(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Metrics once for each row of a short table of settings."""
    return metrics.crossJoin(F.broadcast(thresholds))


def step_verdict(families: list[Column], landmark: Column, region: Column) -> Column:
    """True if any family says so, null counting as false; null again where false and neither landmarks nor regions decide."""
    any_true = F.coalesce(families[0], F.lit(False))
    for f in families[1:]:
        any_true = any_true | F.coalesce(f, F.lit(False))
    return F.when(~any_true & landmark.isNull() & region.isNull(), F.lit(None)).otherwise(any_true)


def overall_verdict(ims: Column, preims_postims: Column, preimc_preims: Column, postimc_preimc: Column, postimc_postims: Column) -> Column:
    """The chain of four steps, or the direct one; false with an unknown input is unknown."""
    parts = [ims, preims_postims, preimc_preims, postimc_preimc, postimc_postims]
    v = (ims & preims_postims & preimc_preims & postimc_preimc) | postimc_postims
    unknown = parts[0].isNull()
    for p in parts[1:]:
        unknown = unknown | p.isNull()
    return F.when(F.coalesce(v, F.lit(False)), True).when(unknown, F.lit(None)).otherwise(v)


def verdict_table(df: DataFrame, cols: list[str], long: bool = False) -> DataFrame:
    """The verdicts of each sample, one column each or one row each (step, keep)."""
    wide = df.select("sample", *cols)
    return A.to_long(wide, ["sample"], cols, "step", "keep") if long else wide


def step_summary(df: DataFrame, step: str, digits: int = 3) -> DataFrame:
    """The metrics of a step under their short names, with completeness where counts are there, to significant digits."""
    s = select_step(df, step)
    if {"n_found", "n_expected"} <= set(s.columns):
        s = A.completeness(s)
    return s.select("sample", *[signif(F.col(c), digits).alias(c) for c in s.columns if c != "sample"])


def metric_missing(df: DataFrame, families: dict[str, list[str]]) -> DataFrame:
    """For each family, whether any of its metrics is missing."""
    def missing(cols: list[str]) -> Column:
        out = F.col(cols[0]).isNull()
        for c in cols[1:]:
            out = out | F.col(c).isNull()
        return out

    return df.select("sample", *[missing(c).alias(f"{k}_missing") for k, c in families.items()])


def metric_overview(wide: DataFrame, metrics: list[str], lookup: DataFrame) -> DataFrame:
    """Long table of metrics with confidence, type, evaluation and step; values clamped for display."""
    long = A.to_long(wide, ["sample"], metrics, "metric", "value")
    named = joins.join_confidence(long, lookup).withColumn("c", classify_metric(F.col("metric")))
    out = named.select("sample", "metric", "value", "confidence", "c.type", "c.evaluation", "c.step")
    return out.withColumn("confidence", confidence(F.col("confidence"), F.col("evaluation"))).withColumn("shown", clamp_for_display(F.col("value"), F.col("type")))


def association_table(fit: DataFrame, digits: int = 3) -> DataFrame:
    """Fit with the false discovery rate of each term, to significant digits."""
    q = fdr(fit, "p_value", ["term"], "fdr")
    return q.withColumns({c: signif(F.col(c), digits) for c in ("estimate", "std_error", "p_value", "fdr")})


def association_matrix(fit: DataFrame, value: str, types: list[str], term: str = "(Intercept)") -> DataFrame:
    """m/z by cell type of the estimate or of -log10 FDR, for one term, without rho."""
    x = F.col("estimate") if value == "estimate" else -F.log10("fdr")
    return fit.where((F.col("term") == term) & (F.col("celltype") != "rho")).withColumn("_v", x).groupBy("mz").pivot("celltype", types).agg(F.first("_v"))


def volcano(fit: DataFrame, term: str, alpha: float = 0.05) -> DataFrame:
    """Estimate and -log10 of the false discovery rate of one term, with a label where it is below alpha."""
    f = fit.where(F.col("term") == term)
    hit = F.col("fdr") < alpha
    return f.select("mz", "celltype", "estimate", (-F.log10("fdr")).alias("neg_log10_fdr"), hit.alias("significant"), F.when(hit, F.concat_ws(" ", "celltype", F.col("mz").cast("string"))).alias("label"))


def binned_counts(df: DataFrame, col: str, width: float, keys: list[str] = ()) -> DataFrame:
    return df.groupBy(*keys, (F.floor(F.col(col) / width) * width).alias("bin")).agg(F.count("*").alias("n"))


def region_pair_metrics(r1: DataFrame, r2: DataFrame, pixels1: DataFrame, pixels2: DataFrame, dmax: float) -> DataFrame:
    """One-to-one region pairs with centroid distance and Dice: candidates, best shape match, uniqueness."""
    from mosaica.operators.rasters import region_moments, shape_distance

    m1, m2 = region_moments(pixels1), region_moments(pixels2)
    cand = joins.region_candidates(r1, r2, dmax)
    hu = [f"hu{i}" for i in range(1, 8)]
    both = m1.select("id", *hu).unionByName(m2.select((-F.col("id") - 1).alias("id"), *hu))
    scored = shape_distance(cand.withColumn("other", -F.col("other") - 1), both).withColumn("other", -F.col("other") - 1)
    best = graphs.one_to_one(graphs.best_shape_match(scored).join(cand, ["id", "other"]))
    d = A.max_dice(pixels1, pixels2)
    return best.join(d.select("id", F.col("other").alias("_o"), F.col("dice").alias("_d")), "id", "left").select("id", "other", "d", F.when(F.col("_o") == F.col("other"), F.col("_d")).otherwise(0.0).alias("dice"))
