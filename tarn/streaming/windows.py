"""Five-minute system metrics on a stream, with a watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.functions.times import is_off_hours

LANES = 16


def bucket_metrics_stream(df: DataFrame, delay: str = "10 minutes", width: str = "5 minutes", ts: str = "ts") -> DataFrame:
    """Tumbling-window metrics, each window emitted once when the watermark passes its end.

    Distinct counts are exact and a busy window is not held by one task: the first
    aggregation keeps state per (window, user), (window, address) and (window, lane),
    the second adds those rows up. Events later than ``delay`` are dropped.
    """
    no: Column = F.lit(None).cast("double")

    def part(kind: str, value: Column, **numbers: Column) -> Column:
        names = ["failed", "failures", "mfa", "off", "ok"]
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"),
                        *[numbers.get(n, no).cast("double").alias(n) for n in names])

    lane = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(LANES))
    parts = F.array(
        part("user", F.col("user_id")), part("ip", F.col("ip_address")),
        part("rows", lane, failed=F.col("failed_attempts_before"), failures=(F.col("failed_attempts_before") > 0).cast("int"),
             mfa=F.col("mfa_used").cast("int"), off=is_off_hours(ts).cast("int"), ok=F.col("success").cast("int")))
    spread = df.withWatermark(ts, delay).select(ts, F.inline(parts))
    first = spread.groupBy(F.window(ts, width).alias("window"), "kind", "value").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("failed", "failures", "mfa", "off", "ok")],
        *[F.count(c).alias(f"n_{c}") for c in ("failed", "failures", "mfa", "off", "ok")])
    rows = F.col("kind") == "rows"
    second = first.groupBy(F.window(F.window_time("window"), width).alias("window")).agg(
        F.sum(F.when(rows, F.col("n"))).alias("total_logins"),
        F.count_if((F.col("kind") == "user") & F.col("value").isNotNull()).alias("distinct_users"),
        F.count_if((F.col("kind") == "ip") & F.col("value").isNotNull()).alias("distinct_ips"),
        *[F.try_divide(F.sum(c), F.sum(f"n_{c}")).alias(name) for c, name in (
            ("failed", "avg_failed_attempts_before"), ("failures", "failure_rate"), ("mfa", "mfa_rate"),
            ("off", "off_hours_share"), ("ok", "success_rate"))])
    return second.select(F.col("window.start").alias("bucket_ts"), *[c for c in second.columns if c != "window"])
