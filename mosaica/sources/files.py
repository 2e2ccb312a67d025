"""Scans and sinks of the tabular, JSON and GeoJSON files of the data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHEET = (
    "sample_name string, project_name string, core_name string, reg_type string, do_register_IMC_location boolean, "
    "register_IMC_location_with_pycpd boolean, IMS_pixel_size double, IMS_shrink_factor double, IMC_pixel_size double, "
    "microscopy_pixel_size double, coords_filename string, imzml_filename string, postIMSpreIMSmask string, "
    "IMS_rotation_angle int, IMC_rotation_angle int, IMS_to_postIMS_n_splits int, IMS_to_postIMS_init_gridsearch int, "
    "within_IMC_fine_registration boolean, min_index_length int, max_index_length int"
)
MATCHES = (
    "p1x double, p1y double, p2x double, p2y double, distance double, distance_ratio double, homography_mask int, "
    "on_tissue int, distance_physical double, angle double, i int, j int"
)
TABLES = {
    "spectra": "project string, imzml string, ims_idx int, x int, y int, mz double, intensity double",
    "peaks": "ims_idx int, mz double, value double",
    "coords": "coords_id string, seq int, x_orig int, y_orig int, x_pad int, y_pad int, x_um double, y_um double",
    "raster": "image_id string, channel int, row int, col int, value double",
    "labels": "image_id string, row int, col int, label int",
}


def sample_from_path(suffix: str) -> Column:
    """Sample id of a row: the file's name without what the pattern matches."""
    return F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), suffix, "")


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The sheet with its order in `seq` (files of a folder one after the other)."""
    return spark.read.csv(path, schema=SHEET, header=True).withColumn("seq", F.monotonically_increasing_id())


def read_csv_per_sample(spark: SparkSession, path: str, suffix: str, schema: str | None = None, sample: Column | None = None) -> DataFrame:
    """All files of a glob as one table, with the column `sample`: the file's name without the suffix, or an expression on _metadata."""
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return df.select((sample if sample is not None else sample_from_path(suffix)).alias("sample"), "*")


def read_metric_json(spark: SparkSession, path: str, suffix: str, sample: Column | None = None, lines: bool = False) -> DataFrame:
    """(sample, metric, value) of flat JSON objects whose numbers are written as strings: one a file, the sample as in read_csv_per_sample, or one a line with its sample beside it."""
    text = spark.read.text(path, wholetext=not lines)
    if lines:
        raw = text.select(F.from_json("value", "sample string, metrics map<string,string>").alias("o")).select("o.sample", F.col("o.metrics").alias("m"))
    else:
        raw = text.select((sample if sample is not None else sample_from_path(suffix)).alias("sample"), F.from_json("value", "map<string,string>").alias("m"))
    return raw.select("sample", F.explode("m").alias("metric", "v")).select("sample", "metric", F.col("v").try_cast("double").alias("value"))


def read_geojson(spark: SparkSession, path: str, layer: str, lines: bool = False, properties: list[str] = ()) -> DataFrame:
    """(layer, name, ring, further properties as strings) of files that hold one Feature or a list of them, or one Feature a line."""
    named = ",".join(f"`{n}`:string" for n in ["name", *properties])
    feature = f"struct<geometry:struct<type:string,coordinates:array<array<array<double>>>>,properties:struct<{named}>>"
    text = spark.read.text(path, wholetext=not lines)
    listed = F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(F.concat(F.lit("["), "value", F.lit("]")))
    f = text.select(F.explode(F.from_json(listed, f"array<{feature}>")).alias("f"))
    ring = F.transform(F.get("f.geometry.coordinates", F.lit(0)), lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return f.select(F.lit(layer).alias("layer"), F.col("f.properties.name").alias("name"), ring.alias("ring"), *[F.col(f"f.properties.{n}").alias(n) for n in properties])


def read_registration_meta(spark: SparkSession, path: str, schema: str | None = None, lines: bool = False) -> DataFrame:
    """One row a file, or a line: landmark lists and matrices as nested arrays, by the given schema; without one it is inferred from the data."""
    reader = spark.read.option("multiLine", not lines)
    return (reader.schema(schema) if schema else reader).json(path)


def read_regions(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(file, region_id, ring, bbox) of region files, one object a file or a line."""
    schema = "regions array<array<array<double>>>, bboxes array<array<double>>"
    df = spark.read.schema(schema).option("multiLine", not lines).json(path)
    r = df.select(F.col("_metadata.file_path").alias("file"), F.posexplode("regions").alias("region_id", "r"), "bboxes")
    ring = F.transform("r", lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    b = F.get("bboxes", F.col("region_id"))
    return r.select("file", "region_id", ring.alias("ring"), F.struct(*[F.get(b, F.lit(i)).alias(n) for i, n in enumerate("xywh")]).alias("bbox"))


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=MATCHES, header=True)


def read_table(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """A table of one of the kinds of TABLES from parquet, or from CSV where the path ends so."""
    if path.endswith(".csv"):
        return spark.read.csv(path, schema=TABLES[kind], header=True)
    return spark.read.schema(TABLES[kind]).parquet(path)


def write_csv(df: DataFrame, path: str, order: list[str] = ()) -> None:
    """A folder of CSV files with headers. With `order` the files in the order of their names hold the rows sorted by those columns (nulls first), by ranges, so that no task
    sorts all; cell tables are sorted by cell id."""
    (df.orderBy(*order) if order else df).write.csv(path, header=True)


def write_mz_slices(df: DataFrame, path: str, index: bool = False, checker: bool = False) -> None:
    """One folder for every m/z value; rows of a value are dealt by pixel, so that a common value is written by many tasks. With index, a further slice
    of m/z -1 holds each pixel's number; with checker (df with row, col), one of m/z -2 the chequered control image."""
    from mosaica.operators.rasters import checker_slice, index_slice

    px = df.drop("mz", "value", "intensity").distinct()
    for wanted, slice_, mz in ((index, index_slice, -1.0), (checker, checker_slice, -2.0)):
        if wanted:
            df = df.unionByName(slice_(px).withColumn("mz", F.lit(mz)), allowMissingColumns=True)
    df.repartition(F.col("mz"), F.pmod(F.xxhash64("ims_idx"), F.lit(8))).write.partitionBy("mz").parquet(path)


def write_geojson(df: DataFrame, path: str) -> None:
    """(name, ring, other columns) as one GeoJSON Feature a line; other columns become properties, but for `classification`."""
    ring = F.transform("ring", lambda p: F.array(p.x, p.y))
    rest = [c for c in df.columns if c not in ("name", "ring", "classification")]
    kind = [] if "objectType" in rest else [F.lit("annotation").alias("objectType")]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        F.struct(*kind, F.col("name"), *rest).alias("properties"),
    )
    df.select(F.to_json(feature).alias("value")).write.text(path)


def _metric_map(df: DataFrame, step: str) -> DataFrame:
    pair = F.struct(F.concat(F.lit(f"{step}_"), "metric"), F.col("value").cast("string"))
    return df.groupBy("sample").agg(F.map_from_entries(F.array_sort(F.collect_list(pair))).alias("metrics"))


def metric_json(df: DataFrame, step: str) -> DataFrame:
    """(sample, value): a flat JSON object of the metrics (sample, metric, value) with the step before every name, values as strings."""
    return _metric_map(df, step).select("sample", F.to_json("metrics").alias("value"))


def write_metric_json(df: DataFrame, path: str, step: str, lines: bool = False) -> None:
    """One file a sample, in a folder of its own, for tools that read them so; or, for many samples, one object a line with the sample beside its metrics, so that the
    number of files follows their bytes and not the number of samples."""
    if lines:
        _metric_map(df, step).select(F.to_json(F.struct(F.col("sample").cast("string").alias("sample"), "metrics")).alias("value")).write.text(path)
    else:
        metric_json(df, step).write.partitionBy("sample").text(path)
