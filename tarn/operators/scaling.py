"""Column scaling with fitted bounds kept as a one-row model frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_standard(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[x for c in columns for x in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"))])


def apply_standard(df: DataFrame, model: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / std with the fitted values; a zero spread divides by 1."""
    m = model.select(F.struct(*model.columns).alias("m")).scalar()
    out = df.withColumn("_m", m)
    scaled = {}
    for c in columns:
        std = F.col(f"_m.{c}_std")
        scaled[c] = (F.col(c) - F.col(f"_m.{c}_mean")) / F.when(std > 0, std).otherwise(F.lit(1.0))
    return out.withColumns(scaled).drop("_m")


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[x for c in columns for x in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))])


def apply_minmax(df: DataFrame, model: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """To [0, 1] with the fitted bounds; a constant column becomes 0."""
    m = model.select(F.struct(*model.columns).alias("m")).scalar()
    out = df.withColumn("_m", m)
    scaled = {}
    for c in columns:
        lo, hi = F.col(f"_m.{c}_min"), F.col(f"_m.{c}_max")
        scaled[c + suffix] = F.when(hi > lo, (F.col(c) - lo) / (hi - lo)).otherwise(F.lit(0.0))
    return out.withColumns(scaled).drop("_m")


def minmax(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Fit and apply on the same rows."""
    return apply_minmax(df, fit_minmax(df, columns), columns, suffix)
