"""Threshold tuning and analyst feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FEEDBACK_SCHEMA = ("login_id long, analyst_id string not null, review_timestamp timestamp not null, "
                   "is_true_positive boolean not null, threat_category string, notes string")
STEPS = 20


def threshold_sweep(df: DataFrame, score: str, truth: str, days: float, steps: int = STEPS) -> DataFrame:
    """Precision, recall, F1, alert volume for thresholds 0, 1/steps … 1.

    Every row is counted once, into the highest threshold it reaches; the table of
    ``steps + 1`` rows is then summed from the top.
    """
    reached = F.greatest(F.lit(-1), F.least(F.lit(steps), F.floor(F.round(F.col(score) * steps, 9)))).cast("int")
    counted = df.filter(F.col(score).isNotNull()).groupBy(reached.alias("step")).agg(
        F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) == 0).alias("neg"))
    grid = df.sparkSession.range(-1, steps + 1).select(F.col("id").cast("int").alias("step"))
    table = grid.join(F.broadcast(counted), "step", "left").fillna(0, ["pos", "neg"])
    from_top = Window.partitionBy(F.lit(0)).orderBy(F.desc("step"))
    everything = Window.partitionBy(F.lit(0))
    table = table.select("step", F.sum("pos").over(from_top).alias("true_positives"),
                         F.sum("neg").over(from_top).alias("false_positives"), F.sum("pos").over(everything).alias("_all"))
    tp, fp = F.col("true_positives"), F.col("false_positives")
    precision = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, F.col("_all")), F.lit(0.0))
    out = table.filter("step >= 0").select(
        F.round(F.col("step") / steps, 4).alias("threshold"), precision.alias("precision"), recall.alias("recall"),
        ((tp + fp) / F.lit(float(days))).alias("alerts_per_day"), "true_positives", "false_positives")
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)))


def best_threshold(sweep: DataFrame, capacity: float = 50.0) -> DataFrame:
    """The threshold of maximal F1 and the first one within the alert capacity (else the last)."""
    best = sweep.orderBy(F.desc("f1"), "threshold").limit(1).withColumn("criterion", F.lit("max_f1"))
    fits = F.col("alerts_per_day") <= capacity
    within = sweep.orderBy(F.desc(fits), F.when(fits, F.col("threshold")).otherwise(-F.col("threshold"))).limit(1)
    return best.unionByName(within.withColumn("criterion", F.lit("capacity")))


def feedback_labels(scores: DataFrame, feedback: DataFrame, key: str = "login_id") -> DataFrame:
    """Scores with the newest analyst verdict per event, usable as a label."""
    newest = feedback.groupBy(key).agg(F.max_by("is_true_positive", F.struct("review_timestamp", "analyst_id")).alias("verdict"))
    return scores.join(newest, key, "left")
