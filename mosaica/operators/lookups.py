"""Projections, filters, constraint checks and lookups."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mosaica.functions import geometry as G


def validate_sheet(df: DataFrame, rules: dict[str, dict], key: str = "sample_name") -> DataFrame:
    """(key, column, rule) of every violation.

    A column's rules: required, pattern, minimum, maximum, exclusiveMinimum, multipleOf. Null breaks `required` alone.
    """
    checks = []
    for col, r in rules.items():
        x = F.col(col)
        tests = {
            "required": lambda v: x.isNull() if v else F.lit(False),
            "pattern": lambda v: ~x.rlike(v),
            "minimum": lambda v: x < v,
            "maximum": lambda v: x > v,
            "exclusiveMinimum": lambda v: x <= v,
            "multipleOf": lambda v: F.abs(x / v - F.round(x / v)) > 1e-9,
        }
        for name, value in r.items():
            if name != "default":
                checks.append(F.when(F.coalesce(tests[name](value), F.lit(False)), F.struct(F.lit(col).alias("column"), F.lit(name).alias("rule"))))
    return df.select(key, F.explode(F.filter(F.array(*checks), lambda c: c.isNotNull())).alias("c")).select(key, "c.column", "c.rule")


def with_defaults(df: DataFrame, rules: dict[str, dict]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(r["default"])) for c, r in rules.items() if "default" in r})


def lookup(df: DataFrame, key: str, value, out: str, all: bool = False, order: str | None = None) -> DataFrame:
    """The column `out` of rows where key is value, null as ''; the first in the given order (by default the sheet's: `seq` where there is one, else
    `out` itself), or all."""
    return _found(df.where(F.col(key) == value), out, all, order)


def lookup2(df: DataFrame, k1: str, v1, k2: str, v2, out: str, all: bool = False, order: str | None = None) -> DataFrame:
    """The same by two keys."""
    return _found(df.where((F.col(k1) == v1) & (F.col(k2) == v2)), out, all, order)


def _found(df: DataFrame, out: str, all: bool, order: str | None) -> DataFrame:
    order = order or ("seq" if "seq" in df.columns else out)
    got = df.select(F.coalesce(F.col(out).cast("string"), F.lit("")).alias(out), *([order] if order != out else []))
    return got.select(out) if all else got.orderBy(order).limit(1).select(out)


def resolve_coords(df: DataFrame, folder: str = "results") -> DataFrame:
    """coords_path: the named file, or the derived one where the name is empty or null."""
    name = F.coalesce(F.trim("coords_filename"), F.lit(""))
    derived = F.concat_ws("/", F.lit(folder), "project_name", F.concat("sample_name", F.lit("_coords.parquet")))
    return df.withColumn("coords_path", F.when(name == "", derived).otherwise(F.col("coords_filename")))


def distinct_runs(df: DataFrame) -> DataFrame:
    return df.select(F.regexp_replace("imzml_filename", r"\.imzML$", "").alias("imzml"), "project_name").distinct()


def project_cores(df: DataFrame) -> DataFrame:
    return df.groupBy("project_name").agg(F.array_sort(F.collect_set("core_name")).alias("cores"))


def select_channels(raster: DataFrame, panel: DataFrame, names: Iterable[str]) -> DataFrame:
    """Raster rows of the named channels, all if none is named; the panel (channel, name) is small by nature. Unknown names raise."""
    names = list(names)
    if not names:
        return raster.join(F.broadcast(panel), "channel")
    known = {r[0] for r in panel.where(F.col("name").isin(names)).select("name").distinct().collect()}
    if missing := sorted(set(names) - known):
        raise ValueError(f"channels not in the panel: {missing}")
    return raster.join(F.broadcast(panel.where(F.col("name").isin(names))), "channel")


def crop(df: DataFrame, bbox: tuple[int, int, int, int], channel: int | None = None) -> DataFrame:
    """Rows in [r0, r1) x [c0, c1); plain comparisons, so that they reach the scan."""
    r0, r1, c0, c1 = bbox
    out = df.where((F.col("row") >= r0) & (F.col("row") < r1) & (F.col("col") >= c0) & (F.col("col") < c1))
    return out if channel is None else out.where(F.col("channel") == channel)


def prune_mass_range(spectra: DataFrame, peaklist: DataFrame, margin: float = 1.0) -> DataFrame:
    """Only m/z within the reference list's range and a margin; the bounds are read first, so the filter is pushed down."""
    lo, hi = peaklist.agg(F.min("mz"), F.max("mz")).first()
    return spectra.limit(0) if lo is None else spectra.where(F.col("mz").between(lo - margin, hi + margin))


def select_step(df: DataFrame, step: str, key: str = "sample") -> DataFrame:
    """The columns of a step (a_to_b_ before, _a_to_b or _a_b after), without it, and `quantile` as `Q`."""
    marks = [f"^{step}_", f"_{step}$", f"_{step.replace('_to_', '_')}$"]
    out = [F.col(key)]
    for c in df.columns:
        hit = next((m for m in marks if re.search(m, c)), None)
        if c != key and hit:
            out.append(F.col(c).alias(re.sub(hit, "", c).replace("quantile", "Q")))
    return df.select(*out)


def mz_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if re.search(r"^X?[0-9]{4}(\.[0-9]+)?$", c)]


def drop_unannotated(df: DataFrame) -> DataFrame:
    """Without rows of a cell that has no cell type; pixels without cells stay."""
    return df.where(~(F.col("cell_idx").isNotNull() & F.col("celltype").isNull()))


def keep_in_area(df: DataFrame) -> DataFrame:
    return df.where(F.col("in_IMC") & F.col("to_keep_reg"))


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def drop_small_regions(regions: DataFrame, reference: DataFrame, frac: float = 0.05) -> DataFrame:
    """Without regions smaller than a share of the smallest reference region (columns area)."""
    least = reference.agg((F.min("area") * frac).alias("_least"))
    return regions.crossJoin(F.broadcast(least)).where(F.col("area") >= F.col("_least")).drop("_least")  # one row


def filter_region_size(regions: DataFrame, lo: float, hi: float) -> DataFrame:
    return regions.withColumn("area", G.ring_area(F.col("ring"))).where(F.col("area").between(lo, hi)).withColumn("bbox", G.ring_bbox(F.col("ring")))


def drop_border_regions(regions: DataFrame, width: float, height: float) -> DataFrame:
    return regions.where(~F.exists("ring", lambda p: (p.x <= 0) | (p.y <= 0) | (p.x >= width - 1) | (p.y >= height - 1)))


def guard_min_count(df: DataFrame, keys: list[str], aggregates: dict, n: int = 5) -> DataFrame:
    """Aggregates per group, null where it has fewer than n rows; n_rows says how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), *[F.when(F.count("*") >= n, a).alias(k) for k, a in aggregates.items()])


def flag_outliers(df: DataFrame, col: str, k: float = 1.0) -> DataFrame:
    """Rows whose value exceeds median + k * MAD."""
    from mosaica.operators.aggregates import mad

    return df.crossJoin(F.broadcast(mad(df, col))).where(F.col(col) > F.col("median") + k * F.col("mad")).drop("median", "mad")  # one row


def select_families(metrics: DataFrame, families: list[str], steps: list[str]) -> DataFrame:
    return metrics.where(F.col("family").isin(families) & F.col("step").isin(steps))


def first_by(df: DataFrame, keys: list[str], *order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
