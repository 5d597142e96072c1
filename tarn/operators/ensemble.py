"""Combining detectors: agreement, similarity, averaged and weighted scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions.values import tier
from tarn.operators.quantiles import exact_quantiles, unpivot
from tarn.operators.scaling import apply_minmax, fit_minmax

COMPOSITE_WEIGHTS = {"iforest_signal": 0.35, "ecod_signal": 0.30, "per_user_signal": 0.35}
FLAG_SCORE = 0.6


def _sum(columns: Sequence[str]):
    return reduce(lambda a, b: a + b, [F.col(c) for c in columns])


def agreement(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows by the number of detectors that flagged them."""
    return df.groupBy(_sum(flags).cast("int").alias("n_detectors_flagged")).agg(F.count(F.lit(1)).alias("n_rows"))


def jaccard_matrix(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Pairwise |A and B| / |A or B| of the flags in one pass; 0 for an empty union."""
    pairs = [(a, b) for a in flags for b in flags]
    both = [F.sum(F.col(a) * F.col(b)).alias(f"i_{a}__{b}") for a, b in pairs]
    either = [F.sum(F.greatest(a, b)).alias(f"u_{a}__{b}") for a, b in pairs]
    cells = F.array(*[F.struct(F.lit(a).alias("detector_a"), F.lit(b).alias("detector_b"), F.coalesce(
        F.try_divide(F.col(f"i_{a}__{b}"), F.col(f"u_{a}__{b}")), F.lit(0.0)).alias("jaccard")) for a, b in pairs])
    return df.agg(*both, *either).select(F.inline(cells))


def ensemble(df: DataFrame, scores: Sequence[str], iforest: str | None = None) -> DataFrame:
    """Mean of the scaled detector scores; with ``iforest`` also the mean with its negated, scaled score."""
    out = df.withColumn("_neg", -F.col(iforest)) if iforest else df
    scaled = [*scores, *(["_neg"] if iforest else [])]
    out = apply_minmax(out, fit_minmax(out, scaled), scaled, "_norm")
    out = out.withColumn("ensemble_score", _sum([f"{c}_norm" for c in scores]) / len(scores))
    if iforest:
        out = out.withColumn("ensemble_with_iforest", (F.col("ensemble_score") + F.col("_neg_norm")) / 2)
    return out.drop("_neg", *[f"{c}_norm" for c in scaled])


def score_statistics(df: DataFrame, score: str) -> DataFrame:
    return df.agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.min(score).alias("min"),
                  F.max(score).alias("max"))


def contamination_sweep(scored: DataFrame, score: str, shares: Sequence[float] = (0.02, 0.05, 0.08, 0.10)) -> DataFrame:
    """Flagged count and share per contamination: the model is fitted once, only the threshold moves."""
    edges = exact_quantiles(scored, score, list(shares)).agg(
        F.map_from_entries(F.collect_list(F.struct("prob", "quantile"))).alias("m")).scalar()
    below = scored.select(score, edges.alias("_m")).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(score) < F.col("_m")[F.lit(float(c))]).alias(f"c{i}") for i, c in enumerate(shares)])
    rows = F.array(*[F.struct(F.lit(float(c)).alias("contamination"), F.col(f"c{i}").alias("flagged"), F.col("total"))
                     for i, c in enumerate(shares)])
    return below.select(F.inline(rows)).withColumn("share", F.col("flagged") / F.col("total"))


def feature_divergence(df: DataFrame, columns: Sequence[str], flag: str) -> DataFrame:
    """|mean of flagged - mean of normal| / std per feature."""
    long = unpivot(df, columns, [flag])
    g = long.groupBy("feature").agg(
        F.avg(F.when(F.col(flag) == 1, F.col("value"))).alias("flagged_mean"),
        F.avg(F.when(F.col(flag) == 0, F.col("value"))).alias("normal_mean"), F.stddev_samp("value").alias("std"))
    gap = F.abs(F.col("flagged_mean") - F.col("normal_mean"))
    return g.withColumn("divergence", F.when(F.col("std") > 0, gap / F.col("std")).otherwise(F.lit(0.0)))


def fit_composite(df: DataFrame) -> DataFrame:
    """Bounds of the three layers and of their weighted sum, as one model row.

    Expects iforest (lower is worse), ecod (higher is worse), per_user (lower is worse).
    """
    layers = fit_minmax(_oriented(df), ["iforest_signal", "ecod_signal", "per_user_signal"])
    raw = _weighted(apply_minmax(_oriented(df), layers, list(COMPOSITE_WEIGHTS)))
    packed = fit_minmax(raw, ["raw"]).select(F.struct("*").alias("s")).scalar()
    return layers.withColumn("_s", packed).select(*layers.columns, "_s.raw_min", "_s.raw_max")


def _oriented(df: DataFrame) -> DataFrame:
    return df.withColumns({"iforest_signal": -F.col("iforest"), "ecod_signal": F.col("ecod"), "per_user_signal": -F.col("per_user")})


def _weighted(df: DataFrame) -> DataFrame:
    return df.withColumn("raw", reduce(lambda a, b: a + b, [F.lit(w) * F.col(c) for c, w in COMPOSITE_WEIGHTS.items()]))


def composite_risk(df: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Weighted risk in [0, 1], tier and flag. Stored bounds make a row's score independent of its batch."""
    model = bounds if bounds is not None else fit_composite(df)
    out = _weighted(apply_minmax(_oriented(df), model, list(COMPOSITE_WEIGHTS)))
    out = apply_minmax(out, model, ["raw"]).withColumn("risk_score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "raw")))
    return out.drop("raw").withColumns({
        "risk_tier": tier("risk_score"), "is_anomaly": F.when(F.col("risk_score") >= FLAG_SCORE, 1).otherwise(0)})
