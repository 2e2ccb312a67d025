"""End-to-end jobs composed of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaica.functions import geometry as G
from mosaica.functions.scalars import filled, log2_na
from mosaica.operators import aggregates as A
from mosaica.operators import joins, lookups, models, rasters, windows
from mosaica.operators.lineage import cut


def process_spectra(spectra: DataFrame, peaklist: DataFrame, tol: float = 0.02, transform=None) -> DataFrame:
    """(ims_idx, mz, value): pruned, TIC-normalised, aligned, binned, transformed (log2 by default; any function of a column)."""
    kept = lookups.prune_mass_range(spectra, peaklist)
    total = A.tic(spectra)
    scaled = kept.join(total, "ims_idx").withColumn("intensity", F.col("intensity") * F.col("n_features") / F.when(F.col("tic") > 0, F.col("tic")))
    out = A.bin_peaks(joins.align_peaks(scaled.drop("tic", "n_features"), peaklist, tol))
    return out.withColumn("value", (transform or log2_na)(F.col("value")))


def peak_table(peaks: DataFrame, coords: DataFrame, spacing: float) -> DataFrame:
    """Peaks (ims_idx, x, y on the original grid, ...) with physical x_um, y_um from matched coordinates; axes are exchanged when both
    correlate below -0.99."""
    placed = joins.join_coords_peaks(joins.pixel_positions(coords, spacing).withColumnsRenamed({"x": "phys_x", "y": "phys_y"}), peaks)
    turned = placed.agg((F.corr("x_orig", "phys_x") < -0.99).alias("a"), (F.corr("y_orig", "phys_y") < -0.99).alias("b")).select((F.col("a") & F.col("b")).alias("_swap"))
    swap = F.coalesce("_swap", F.lit(False))
    return placed.crossJoin(F.broadcast(turned)).withColumn("_x", F.when(swap, F.col("phys_y")).otherwise(F.col("phys_x"))).withColumn("phys_y", F.when(swap, F.col("phys_x")).otherwise(F.col("phys_y"))).withColumn("phys_x", F.col("_x")).drop("_x", "_swap")  # one row


def combine(pixels: DataFrame, overlaps: DataFrame, centroids: DataFrame, markers: DataFrame | None = None, spacing: float = 1.0, project: str = "") -> DataFrame:
    """The combined pixel-cell table: every pixel (sample_id, ims_idx, x, y, ...) with its cells, their overlap, centroid and markers,
    whether it lies in the hull of pixels with cells, and the plausibility of positions."""
    overlaps = cut(overlaps)  # the dearest join; the table, the hull and the outliers read it
    c = joins.join_cell_centroids(overlaps, centroids.withColumnsRenamed({"x": "cell_x", "y": "cell_y"}))
    table = joins.join_pixels(c, pixels, ["sample_id", "ims_idx"])
    hull = A.convex_hull(pixels.join(overlaps.select("sample_id", "ims_idx").distinct(), ["sample_id", "ims_idx"], "left_semi").select("sample_id", "x", "y"), "sample_id")
    table = table.join(hull, "sample_id", "left").withColumn("in_IMC", F.coalesce(G.in_convex(F.col("x"), F.col("y"), F.col("ring")), F.lit(False))).drop("ring")
    far = A.position_outliers(c.select("sample_id", "ims_idx", F.col("cell_x").alias("x"), F.col("cell_y").alias("y")), spacing).select("sample_id", "ims_idx").withColumn("implausible", F.lit(True))
    table = table.join(far, ["sample_id", "ims_idx"], "left").fillna(False, subset=["implausible"])
    if markers is not None:
        table = joins.join_marker_means(table, markers)
    return table.withColumn("project_name", F.lit(project))


def combine_annotated(pixels: DataFrame, overlaps: DataFrame, centroids: DataFrame, annotation: DataFrame) -> DataFrame:
    """Only pixels with annotated cells."""
    c = joins.join_annotation(joins.join_cell_centroids(overlaps, centroids.withColumnsRenamed({"x": "cell_x", "y": "cell_y"})), annotation, ["sample_id", "cell_idx"], "inner")
    return joins.join_pixels(c, pixels, ["sample_id", "ims_idx"], "inner")


def cells_on_pixels(labels: DataFrame, pixels: DataFrame, raster: DataFrame, spacing: float, channels: list[int], max_dist: float) -> dict[str, DataFrame]:
    """Label raster (sample_id, row, col, label) to polygons, centroids, overlaps and marker means; raster: sample_id, channel, row, col, value.
    Labels are told apart by sample. A label that is no valid polygon has marker means alone; one without raster pixels has null means."""
    polygons = cut(rasters.labels_to_polygons(labels, ["sample_id"]).withColumnRenamed("label", "cell_idx"))  # traced once, read by three
    c = G.ring_centroid(F.col("ring"))
    return {
        "polygons": polygons,
        "centroids": polygons.select("sample_id", "cell_idx", c.alias("c")).select("sample_id", "cell_idx", "c.x", "c.y"),
        "overlaps": joins.cell_pixel_overlap(polygons, pixels, spacing, max_dist=max_dist),
        "markers": A.label_means(labels, raster, channels, ["sample_id"]).withColumnRenamed("label", "cell_idx"),
    }


def prepare(df: DataFrame, annotation: DataFrame, sample_columns: list[str]) -> DataFrame:
    """Annotated table without cells that lost their type; columns constant within samples are filled up and down."""
    j = lookups.drop_unannotated(joins.join_annotation(df, annotation, ["sample_id", "cell_idx"]))
    # constant per sample, so any known value fills: an aggregate and a join instead of a window over whole samples
    known = j.groupBy("sample_id").agg(*[F.max(c).alias(f"_{c}") for c in sample_columns])
    return j.join(known, "sample_id").withColumns({c: F.coalesce(c, f"_{c}") for c in sample_columns}).drop(*[f"_{c}" for c in sample_columns])


def pixel_statistics(df: DataFrame) -> DataFrame:
    return windows.drop_rare_types(windows.pixel_weights(filled(df)))


def wide_table(df: DataFrame, ids: list[str], types: list[str], value: Column) -> DataFrame:
    return A.to_wide(df, ids, "celltype", types, value)


def two_level_association(df: DataFrame, types: list[str], samples: DataFrame, covariates: list[str], method: str = "SAR", column_names: dict[str, str] | None = None) -> DataFrame:
    """Wide rows (mz, sample_id, ims_idx, ims_x, ims_y, value, one column a type) to the second level's table with FDR. column_names maps these
    names to those of df where they differ."""
    df = models.named(df, column_names or {})
    scored = models.zscore(df.where("value is not null"), "value", ["mz"], "z")
    x, names = models.design(scored, types)
    first = models.associate(x, ["mz", "sample_id"], "z", names, method)
    second = models.fit_second(first.select("mz", "sample_id", "term", "estimate", "std_error", "n"), samples, covariates)
    return windows.fdr(second, "p_value", ["term"], "fdr")
