"""Message risk from text: signals from topics, clusters, time and attachments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions.texts import word_count
from tarn.functions.times import is_off_hours, is_weekend
from tarn.functions.values import fill, tier_right
from tarn.operators.scaling import apply_minmax, fit_minmax

# Risk weight per topic index, weight of an unlisted topic, weights of the signals.
TOPIC_RISK = {0: 0.2, 1: 0.8, 2: 0.9, 3: 0.5, 4: 0.6, 5: 0.1}
DEFAULT_TOPIC_RISK = 0.3
SIGNAL_WEIGHTS = {
    "nmf_risk_signal": 0.30, "lda_entropy_signal": 0.10, "embedding_anomaly_signal": 0.30, "attachment_signal": 0.15,
    "temporal_signal": 0.15,
}
BATCH_WEIGHTS = (0.50, 0.25, 0.25 * 0.3)


def text_stats(df: DataFrame) -> DataFrame:
    return df.withColumns({"body_length": F.length("body"), "word_count": word_count("body"),
                           "subject_length": F.length("subject")})


def attachment_signal_log(df: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """0.7 x scaled log size, plus 0.3 with an attachment. ``bounds``: fitted min/max of log_size."""
    sized = fill(df, {"size_mb": 0.0, "has_attachment": False}).withColumn("log_size", F.log1p("size_mb"))
    scaled = apply_minmax(sized, bounds if bounds is not None else fit_minmax(sized, ["log_size"]), ["log_size"])
    signal = F.col("log_size") * 0.7 + F.when(F.col("has_attachment"), 0.3).otherwise(0.0)
    return scaled.withColumn("attachment_signal", signal)


def temporal_signal(ts: str = "ts"):
    return F.when(is_off_hours(ts), 0.5).otherwise(0.0) + F.when(is_weekend(ts), 0.3).otherwise(0.0)


def topic_weight(topic: str, weights: dict[int, float] | None = None):
    out = F.lit(DEFAULT_TOPIC_RISK)
    for index, weight in (TOPIC_RISK if weights is None else weights).items():
        out = F.when(F.col(topic) == index, F.lit(weight)).otherwise(out)
    return out


def nlp_signals(df: DataFrame, weights: dict[int, float] | None = None) -> DataFrame:
    """Five signals per message.

    Expects dominant_topic, topic_confidence, lda_entropy, embedding_cluster,
    cluster_probability, ts, size_mb and has_attachment.
    """
    out = apply_minmax(df, fit_minmax(df, ["lda_entropy"]), ["lda_entropy"], "_signal")
    out = attachment_signal_log(out)
    return out.withColumns({
        "nmf_risk_signal": topic_weight("dominant_topic", weights) * F.col("topic_confidence"),
        "embedding_anomaly_signal": F.when(F.col("embedding_cluster") == -1, 1.0).otherwise(1.0 - F.col("cluster_probability")),
        "temporal_signal": temporal_signal("ts")})


def nlp_risk(signals: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Weighted sum of the signals, scaled to [0, 1], with right-closed tiers."""
    total = F.lit(0.0)
    for name, weight in SIGNAL_WEIGHTS.items():
        total = total + F.col(name) * weight
    out = signals.withColumn("risk_score", total)
    out = apply_minmax(out, bounds if bounds is not None else fit_minmax(out, ["risk_score"]), ["risk_score"])
    return out.withColumn("risk_tier", tier_right("risk_score"))


def fit_batch_bounds(df: DataFrame) -> DataFrame:
    """Bounds of entropy and raw score, stored with the model so that one message can be scored alone."""
    entropy = fit_minmax(df, ["lda_entropy"])
    raw = apply_minmax(df, entropy, ["lda_entropy"], "_signal").select(_batch_raw().alias("raw"))
    score = fit_minmax(raw, ["raw"])
    packed = score.select(F.struct("*").alias("s")).scalar()
    return entropy.withColumn("_s", packed).select("lda_entropy_min", "lda_entropy_max", "_s.raw_min", "_s.raw_max")


def _batch_raw():
    nmf, entropy, rest = BATCH_WEIGHTS
    signal = topic_weight("dominant_topic") * F.col("topic_confidence")
    return F.lit(nmf) * signal + F.lit(entropy) * F.col("lda_entropy_signal") + F.lit(rest)


def nlp_batch_score(df: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Text-only score. Without stored bounds they are fitted on the batch itself."""
    model = bounds if bounds is not None else fit_batch_bounds(df)
    out = apply_minmax(df, model, ["lda_entropy"], "_signal").withColumn("raw", _batch_raw())
    out = apply_minmax(out, model, ["raw"]).withColumnRenamed("raw", "risk_score")
    return out.withColumns({"risk_score": F.greatest(F.lit(0.0), F.least(F.lit(1.0), "risk_score"))})
