"""Joins of events with reference rows, safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions.times import bucket_start
from tarn.session import cut_lineage

BROADCAST_ROWS = 100_000
HOT_ROWS = 1_000_000
LANES = 32


def lookup(facts: DataFrame, reference: DataFrame, on: Sequence[str], how: str = "left",
           max_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS, lanes: int = LANES) -> DataFrame:
    """Join many facts with a reference table that has one row per key.

    The reference is broadcast only after its rows were counted. A larger one is joined by key; keys with more than ``hot_rows`` facts
    are found first, and only their facts are spread over ``lanes`` tasks and only their reference rows repeated. A table has at
    most (number of facts / ``hot_rows``) such keys; all other reference rows are shuffled once.
    """
    on = list(on)
    reference = cut_lineage(reference)  # read twice: counted, then joined
    if reference.limit(max_rows + 1).count() <= max_rows:
        return facts.join(F.broadcast(reference), on, how)
    counts = cut_lineage(facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(*on, F.lit(1).alias("_hot")))
    if counts.isEmpty():
        return facts.join(reference, on, how)
    few = counts.limit(max_rows + 1).count() <= max_rows
    hot = F.broadcast(counts) if few else counts
    spread_out = F.coalesce(F.col("_hot") == 1, F.lit(False)) | reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])  # null keys match nothing
    lane = F.when(spread_out, F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(lanes)).cast("int")).otherwise(0)
    dealt = facts.join(hot, on, "left").withColumn("_lane", lane).drop("_hot")
    every = F.when(F.col("_hot") == 1, F.sequence(F.lit(0), F.lit(lanes - 1))).otherwise(F.array(F.lit(0)))
    repeated = reference.join(hot, on, "left").withColumn("_lane", F.explode(every)).drop("_hot")
    return dealt.join(repeated, [*on, "_lane"], how).drop("_lane")


def unknown_location(df: DataFrame, location: str = "location_name", label: str = "_anomaly_type",
                     normal: str = "normal", history: DataFrame | None = None) -> DataFrame:
    """1 for places never seen in normal rows of ``history`` (default: the same rows)."""
    seen = (df if history is None else history).filter(F.col(label) == normal).select(location).distinct().withColumn("_seen", F.lit(1))
    out = lookup(df, seen, [location])
    return out.withColumn("is_unknown_location", F.when(F.col("_seen") == 1, 0).otherwise(1)).drop("_seen")


def compare_layers(per_user: DataFrame, global_scores: DataFrame, labels: DataFrame, key: str = "login_id") -> DataFrame:
    """Per-user and global scores of an event next to its label."""
    return per_user.join(global_scores, key).join(labels, key)


def explained_top(explained: DataFrame, context: DataFrame, n: int = 20, key: str = "login_id",
                  flag: str = "per_user_anomaly", score: str = "per_user_score") -> DataFrame:
    """Flagged events with their context, worst (lowest) score first."""
    return explained.filter(F.col(flag) == 1).join(context, key).orderBy(score, key).limit(n)


def with_bucket(df: DataFrame, ts: str = "ts", seconds: int = 300) -> DataFrame:
    return df.withColumn("bucket_ts", bucket_start(ts, seconds))


def attack_buckets(scored: DataFrame, events: DataFrame, label: str = "_anomaly_type", attack: str = "brute_force",
                   ts: str = "ts", seconds: int = 300) -> DataFrame:
    """Scored buckets that contain at least one event of the given attack."""
    hit = with_bucket(events.filter(F.col(label) == attack).select(ts), ts, seconds).select("bucket_ts").distinct()
    return scored.join(hit, "bucket_ts", "left_semi")


def scores_with_label(scores: DataFrame, events: DataFrame, columns: Sequence[str] = ("_anomaly_type",),
                      key: str = "login_id", how: str = "inner") -> DataFrame:
    return scores.join(events.select(key, *columns), key, how)


def triage(buckets: DataFrame, events: DataFrame, ts: str = "ts", seconds: int = 300, n: int = 20,
           tiers: Sequence[str] = ("high", "critical")) -> DataFrame:
    """Events inside high-tier buckets, rolled up per bucket, worst first.

    The interval condition is rewritten to equality on the bucket start. The ``n`` worst
    buckets that have events are chosen first, so only their events are rolled up.
    """
    placed = with_bucket(events, ts, seconds)
    high = buckets.filter(F.col("tier").isin(list(tiers))).select("bucket_ts", "tier", "anomaly_score", "top_signal")
    chosen = high.join(placed.select("bucket_ts").distinct(), "bucket_ts", "left_semi").orderBy(F.desc("anomaly_score"), "bucket_ts").limit(n)
    chosen = cut_lineage(chosen)
    inside = placed.join(F.broadcast(chosen.select("bucket_ts").distinct()), "bucket_ts")
    rolled = inside.groupBy("bucket_ts").agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("ip_address").alias("n_ips"),
        F.round(F.avg("failed_attempts_before"), 1).alias("avg_failed"),
        F.array_sort(F.collect_set("_anomaly_type")).alias("anomaly_types_in_bucket"))
    return chosen.join(rolled, "bucket_ts").orderBy(F.desc("anomaly_score"), "bucket_ts").limit(n)


def regular_grid(df: DataFrame, defaults: dict[str, object], ts: str = "bucket_ts", seconds: int = 300,
                 segment: str | None = None) -> DataFrame:
    """Buckets on a gap-free grid from first to last; missing ones get the defaults."""
    keys = [segment] if segment else []
    span = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi")).filter(F.col("_lo").isNotNull())
    step = F.expr(f"INTERVAL {int(seconds)} SECONDS")
    grid = span.select(*keys, F.explode(F.sequence("_lo", "_hi", step)).alias(ts))
    return grid.join(df, [*keys, ts], "left").fillna(defaults)


def lens_compare(event_scores: DataFrame, bucket_scores: DataFrame, attack: str = "brute_force") -> DataFrame:
    """The same attack seen per event and per time bucket: mean score and flagged share, one row each.

    ``event_scores``: score, is_anomaly, _anomaly_type; ``bucket_scores``: the attack's buckets.
    """
    events = event_scores.filter(F.col("_anomaly_type") == attack).agg(
        F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"),
        F.avg("is_anomaly").alias("flagged_share")).withColumn("lens", F.lit("event"))
    buckets = bucket_scores.agg(
        F.count(F.lit(1)).alias("n"), F.avg("anomaly_score").alias("mean_score"),
        F.avg(F.col("tier").isin("high", "critical").cast("int")).alias("flagged_share")).withColumn("lens", F.lit("bucket"))
    return events.unionByName(buckets)


def alert_union(event_scores: DataFrame, buckets: DataFrame, ts: str = "ts", seconds: int = 300,
                key: str = "login_id") -> DataFrame:
    """Events in a high tier of their own, plus every event inside a high or critical bucket."""
    own = event_scores.filter(F.col("risk_tier").isin("Critical", "High")).select(key)
    high = buckets.filter(F.col("tier").isin("high", "critical")).select("bucket_ts", F.lit(1).alias("_high")).distinct()
    inside = lookup(with_bucket(event_scores, ts, seconds).select(key, "bucket_ts"), high, ["bucket_ts"], "inner")
    return own.union(inside.select(key)).distinct()
