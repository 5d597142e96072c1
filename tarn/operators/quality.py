"""Data-quality expectations: drop, warn or fail, with violation counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named condition; a row whose condition is false or NULL violates it."""

    name: str
    condition: str
    action: str = "warn"

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def expect(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Apply the rules: 'drop' removes rows, 'fail' stops the run, 'warn' keeps them."""
    out = df
    for rule in rules:
        if rule.action == "fail":
            guard = F.when(rule.holds(), F.lit(True)).otherwise(
                F.raise_error(F.lit(f"expectation {rule.name} violated")).cast("boolean"))
            out = out.filter(guard)
        elif rule.action not in ("drop", "warn"):
            raise ValueError(f"unknown action {rule.action!r} of rule {rule.name}")
    for rule in rules:
        if rule.action == "drop":
            out = out.filter(rule.holds())
    return out


def violation_counts(rules: Sequence[Rule]) -> list[Column]:
    return [F.count_if(~r.holds()).alias(r.name) for r in rules]


def expectation_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its action and violation count, from a single pass."""
    counted = df.agg(*violation_counts(rules))
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                               F.col(r.name).alias("violations")) for r in rules])
    return counted.select(F.inline(pairs))


def observed(df: DataFrame, rules: Sequence[Rule], observation: Observation | str) -> DataFrame:
    """Attach the violation counts to whatever action consumes the frame."""
    return df.observe(observation, *violation_counts(rules))


def with_warnings(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``warnings``: the names of the warn rules that a kept row violates."""
    names = [F.when(~r.holds(), F.lit(r.name)) for r in rules if r.action == "warn"]
    return df.withColumn("warnings", F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))


def load_checked(df: DataFrame, rules: Sequence[Rule], path: str, log: str) -> None:
    """Write the rows that pass to ``path`` and the violation counts of all rows to ``log``, both from one pass over ``df``."""
    seen = Observation()
    expect(observed(df, rules, seen), rules).write.mode("overwrite").parquet(path)
    write_counts(df.sparkSession, rules, seen.get, log)


def write_counts(spark: SparkSession, rules: Sequence[Rule], counts: Mapping[str, int], log: str) -> None:
    """One row per rule (rule, action, violations), replacing what is at ``log``."""
    rows = [(r.name, r.action, int(counts.get(r.name) or 0)) for r in rules]
    spark.createDataFrame(rows, "rule string, action string, violations long").coalesce(1).write.mode("overwrite").parquet(log)


def email_quality(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_events"), F.count_if("_dq_missing_subject").alias("missing_subject"),
        F.count_if("_dq_missing_sender").alias("missing_sender"), F.count_if("_dq_oversized").alias("oversized_emails"),
        F.count_if("is_off_hours").alias("off_hours_emails"), F.count_if("is_external_sender").alias("external_sender"),
        F.count_if("is_external_recipient").alias("external_recipient"))


def signin_quality(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_events"), F.count_if("login_success").alias("successful_logins"),
        F.count_if(~F.col("login_success")).alias("failed_logins"), F.count_if("is_off_hours").alias("off_hours"),
        F.count_if(~F.col("is_known_location")).alias("unknown_locations"),
        F.count_if(~F.col("mfa_used")).alias("no_mfa"),
        F.count_if(F.col("geo_velocity_kmh") > 900).alias("impossible_travel"),
        F.round(F.avg("geo_velocity_kmh"), 1).alias("avg_geo_velocity_kmh"),
        F.round(F.max("geo_velocity_kmh"), 1).alias("max_geo_velocity_kmh"))
