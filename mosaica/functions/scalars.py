"""Scalar column functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def log2_na(x: Column, floor: float | None = None) -> Column:
    """log2 of x rounded half-even to two decimals; null, or the floor, where that is not positive."""
    r = F.bround(x, 2)
    return F.when(r > 0, F.log2(r)).otherwise(F.lit(floor).cast("double"))


def signif(x: Column, digits: int) -> Column:
    """x rounded to significant digits."""
    k = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x * k) / k)


def strip_name(x: Column, pattern: str) -> Column:
    return F.regexp_replace(x, pattern, "")


def pixel_key(x: Column, y: Column) -> Column:
    return F.concat_ws("_", x, y)


def split_pixel_key(key: Column) -> Column:
    parts = F.split(key, "_")
    return F.struct(F.get(parts, F.lit(0)).cast("int").alias("x"), F.get(parts, F.lit(1)).cast("int").alias("y"))


def to_px(x: Column, spacing_from: float, spacing_to: float) -> Column:
    """Coordinate in units of another spacing, cut towards zero."""
    return (x * spacing_from / spacing_to).cast("int")


def angle_deg(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """Angle a-b-c at b in degrees, signed."""
    ux, uy, vx, vy = ax - bx, ay - by, cx - bx, cy - by
    return F.degrees(F.atan2(ux * vy - uy * vx, ux * vx + uy * vy))


def distance(ax: Column, ay: Column, bx: Column, by: Column, scale: float = 1.0) -> Column:
    return F.hypot(ax - bx, ay - by) * scale


def confidence(n: Column, evaluation: Column) -> Column:
    """Number of regions (out of 10) or landmarks (out of 100) as a confidence in [0, 1]; an unknown number stays null."""
    top = F.when(evaluation == "region", 10.0).otherwise(100.0)
    return F.when(n.isNotNull(), F.least(F.greatest(n / top, F.lit(0.0)), F.lit(1.0)))


def clamp_for_display(value: Column, metric_type: Column) -> Column:
    return F.when(metric_type == "distance", F.least(value, F.lit(10.0))).when(metric_type == "dice", F.greatest(value, F.lit(0.5))).otherwise(value)


def classify_metric(name: Column) -> Column:
    """struct<type, evaluation, step> of a metric's name."""
    kind = F.when(name.contains("dice"), "dice").otherwise("distance")
    what = F.when(name.contains("regions"), "region").otherwise("landmark")
    return F.struct(kind.alias("type"), what.alias("evaluation"), F.regexp_extract(name, "^([A-Za-z]+_to_[A-Za-z]+)", 1).alias("step"))


def beta_inc(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by Simpson's rule on u = sin(theta)**2, which has no singular ends for a, b >= 1/2."""
    from math import lgamma

    a, b, x = (np.asarray(v, float) for v in (a, b, x))
    top = np.arcsin(np.sqrt(np.clip(x, 0, 1)))
    n = 2000
    theta = np.linspace(0, 1, n + 1)[:, None] * top[None, :]
    f = 2 * np.sin(theta) ** (2 * a - 1) * np.cos(theta) ** (2 * b - 1)
    w = np.ones(n + 1)
    w[1:-1:2], w[2:-1:2] = 4, 2
    integral = (w[:, None] * f).sum(0) * top / n / 3
    log_b = np.array([lgamma(p) + lgamma(q) - lgamma(p + q) for p, q in zip(a, b)])
    return np.clip(integral / np.exp(log_b), 0, 1)


def t_pvalues(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided p-values of Student's t."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    out = np.full(t.shape, np.nan)
    ok = np.isfinite(t) & (df > 0)
    # I_x(df/2, 1/2) = 1 - I_(1-x)(1/2, df/2), which is the smooth side for small t
    small = t[ok] ** 2 / (df[ok] + t[ok] ** 2)
    out[ok] = 1 - beta_inc(np.full(ok.sum(), 0.5), df[ok] / 2, small)
    return out


def t_pvalue(t: Column, df: Column) -> Column:
    """Two-sided p-value of Student's t; NaN where t is not finite or the degrees of freedom are not above 0."""

    @F.pandas_udf("double")
    def of(t: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series(t_pvalues(t.to_numpy(float), df.to_numpy(float)))

    return of(t, df)


def normal_pvalues(z: np.ndarray) -> np.ndarray:
    from math import erfc, sqrt

    return np.array([erfc(abs(v) / sqrt(2)) if np.isfinite(v) else np.nan for v in np.asarray(z, float)])


def filled(df: DataFrame) -> DataFrame:
    """Filled area of a cell in its pixel, and of each cell type's share of the pixel (0 without cells)."""
    area = F.coalesce(F.col("overlap") * F.col("cell_area"), F.lit(0.0))
    return df.withColumn("filled_area", area).withColumn("filled_share", F.coalesce(area / F.col("pixel_area"), F.lit(0.0)))
