"""System-wide timeline in 5-minute buckets: residuals, rolling z, bucket score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions.values import tier_z
from tarn.operators.aggregates import bucket_metrics
from tarn.operators.joins import regular_grid
from tarn.operators.sequences import rolling_z

SCORED_METRICS = ["total_logins", "distinct_ips", "avg_failed_attempts_before", "failure_rate"]
# What an empty bucket looks like.
EMPTY_BUCKET = {
    "total_logins": 0, "distinct_users": 0, "distinct_ips": 0, "avg_failed_attempts_before": 0.0, "failure_rate": 0.0,
    "mfa_rate": 0.0, "off_hours_share": 0.0, "success_rate": 1.0,
}
BUCKET_SECONDS = 300
PERIOD = 86_400 // BUCKET_SECONDS


def timeline(events: DataFrame, seconds: int = BUCKET_SECONDS, segment: str | None = None) -> DataFrame:
    """Gap-free bucket series, for the whole system or per segment."""
    return regular_grid(bucket_metrics(events, seconds, segment=segment), EMPTY_BUCKET, seconds=seconds, segment=segment)


def slot_residual(grid: DataFrame, columns: Sequence[str], seconds: int = BUCKET_SECONDS,
                  segment: str | None = None) -> DataFrame:
    """Value minus the median of its time-of-day slot, as ``<column>_resid``.

    A slot holds one row per day, so exact medians stay small however many events there are.
    """
    keys = ([segment] if segment else []) + ["slot"]
    slotted = grid.withColumn("slot", F.floor((F.unix_timestamp("bucket_ts") % 86_400) / seconds))
    usual = slotted.groupBy(*keys).agg(*[F.percentile(c, F.lit(0.5)).alias(f"{c}_usual") for c in columns])
    out = slotted.join(usual, keys)
    return out.withColumns({f"{c}_resid": F.col(c) - F.col(f"{c}_usual") for c in columns}).drop(
        "slot", *[f"{c}_usual" for c in columns])


def bucket_score(df: DataFrame, metrics: Sequence[str] = tuple(SCORED_METRICS)) -> DataFrame:
    """Largest absolute z over the metrics, its metric (first on ties) and the tier."""
    sizes = F.array(*[F.abs(F.col(f"{m}_z")) for m in metrics])
    names = F.array(*[F.lit(m) for m in metrics])
    out = df.withColumn("anomaly_score", F.array_max(sizes))
    top = F.element_at(names, F.array_position(sizes, F.col("anomaly_score")).cast("int"))
    return out.withColumns({"top_signal": top, "tier": tier_z("anomaly_score")})


def scored_timeline(events: DataFrame, seconds: int = BUCKET_SECONDS, segment: str | None = None,
                    days: int = 3, residual: str = "median", digits: int | None = None) -> DataFrame:
    """Timeline with z columns, score and tier. ``residual`` is 'median', 'stl' or 'none'."""
    period = 86_400 // seconds
    out = timeline(events, seconds, segment)
    part = [segment] if segment else []
    if residual == "median":
        out = slot_residual(out, SCORED_METRICS, seconds, segment)
    elif residual == "stl":
        from tarn.operators.seasonal import stl_residual

        out = stl_residual(out, SCORED_METRICS, period, segment)
    else:
        out = out.withColumns({f"{m}_resid": F.col(m).cast("double") for m in SCORED_METRICS})
    if digits is not None:
        out = out.withColumns({f"{m}_resid": F.round(f"{m}_resid", digits) for m in SCORED_METRICS})
    out = rolling_z(out, {f"{m}_resid": f"{m}_z" for m in SCORED_METRICS}, "bucket_ts", days * period, period, part)
    if digits is not None:
        out = out.withColumns({f"{m}_z": F.round(f"{m}_z", digits) for m in SCORED_METRICS})
    return bucket_score(out).drop(*[f"{m}_resid" for m in SCORED_METRICS])
