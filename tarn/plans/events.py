"""Message and sign-in events: silver tables, scores and the unified alert view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.functions.geo import geo_velocity, haversine, impossible_coordinates
from tarn.functions.rules import email_risk, signin_risk
from tarn.functions.times import is_off_hours, is_weekend, parse_ts
from tarn.functions.values import require
from tarn.operators.sequences import minutes_between, with_previous
from tarn.sources.adapters import INTERNAL_DOMAINS, KNOWN_CITIES

OVERSIZED_MB = 100


def _typed(df: DataFrame) -> DataFrame:
    """Timestamps typed, rows without id or time removed, label column dropped."""
    if dict(df.dtypes)["timestamp"] == "string":
        df = df.withColumn("timestamp", parse_ts("timestamp"))
    return require(df.drop("_synthetic_category"), ["event_id", "timestamp"])


def _time_flags() -> dict[str, Column]:
    return {"hour": F.hour("timestamp"), "day_of_week": F.dayofweek("timestamp"),
            "is_off_hours": is_off_hours("timestamp"), "is_weekend": is_weekend("timestamp")}


def direction(df: DataFrame, internal: Sequence[str] = tuple(INTERNAL_DOMAINS)) -> DataFrame:
    """External flags of both ends and the direction; an unknown domain counts as internal."""
    out_s = F.coalesce(~F.col("sender_domain").isin(list(internal)), F.lit(False))
    out_r = F.coalesce(~F.col("recipient_domain").isin(list(internal)), F.lit(False))
    return df.withColumns({
        "is_external_sender": out_s, "is_external_recipient": out_r,
        "direction": F.when(out_s, "inbound").when(out_r, "outbound").otherwise("internal")})


def dq_flags_email(df: DataFrame) -> DataFrame:
    return df.withColumns({"_dq_missing_subject": F.col("subject").isNull(), "_dq_missing_sender": F.col("sender").isNull(),
                           "_dq_oversized": F.col("size_mb") > OVERSIZED_MB})


def place_flags(df: DataFrame, known: Sequence[str] = tuple(KNOWN_CITIES)) -> DataFrame:
    return df.withColumns({"is_known_location": F.col("city").isin(list(known)),
                           "_dq_impossible_coords": impossible_coordinates(F.col("latitude"), F.col("longitude"))})


def dq_flags_signin(df: DataFrame) -> DataFrame:
    return place_flags(df).withColumn("_dq_missing_user", F.col("user_id").isNull())


def silver_email(df: DataFrame) -> DataFrame:
    return dq_flags_email(direction(_typed(df).withColumns(_time_flags())))


def silver_signin(df: DataFrame, known: Sequence[str] = tuple(KNOWN_CITIES)) -> DataFrame:
    """First events have distance and speed 0."""
    out = with_previous(_typed(df), ["timestamp", "latitude", "longitude"], ts="timestamp", tie="event_id")
    km = haversine(F.col("prev_latitude"), F.col("prev_longitude"), F.col("latitude"), F.col("longitude"), 0.0)
    out = out.withColumns({"minutes_since_last": minutes_between("prev_timestamp", "timestamp"), "distance_km": km,
                           **_time_flags()})
    out = out.withColumn("geo_velocity_kmh", geo_velocity(F.col("distance_km"), F.col("minutes_since_last"), 0.0))
    return dq_flags_signin(place_flags(out, known)).drop("prev_timestamp", "prev_latitude", "prev_longitude")


def email_scores(events: DataFrame) -> DataFrame:
    return email_risk(silver_email(events)).select(
        "event_id", "timestamp", "sender", "sender_domain", "recipient", "recipient_domain", "subject", "direction",
        "has_attachment", "attachment_types", "size_mb", "is_off_hours", "is_weekend", "keyword_signal",
        "keyword_category", "attachment_signal", "direction_signal", "temporal_signal", "risk_score", "risk_tier",
        "risk_reasons")


def signin_scores(events: DataFrame) -> DataFrame:
    return signin_risk(silver_signin(events)).select(
        "event_id", "timestamp", "user_id", "ip_address", "city", "country", "latitude", "longitude", "device_type",
        "device_id", "mfa_used", "login_success", "failed_attempts", "application", "geo_velocity_kmh", "distance_km",
        "is_off_hours", "is_weekend", "is_known_location", "geo_signal", "auth_signal", "location_device_signal",
        "temporal_mfa_signal", "risk_score", "risk_tier", "risk_reasons")


def security_alerts(email: DataFrame, signin: DataFrame, tiers: Sequence[str] = ("Critical", "High")) -> DataFrame:
    """High-tier rows of both score tables in one shape."""
    a = email.filter(F.col("risk_tier").isin(list(tiers))).select(
        "event_id", "timestamp", F.lit("email").alias("event_type"), F.col("sender").cast("string").alias("principal"),
        "risk_score", "risk_tier", "risk_reasons", F.col("subject").alias("detail"))
    b = signin.filter(F.col("risk_tier").isin(list(tiers))).select(
        "event_id", "timestamp", F.lit("signin").alias("event_type"), F.col("user_id").cast("string").alias("principal"),
        "risk_score", "risk_tier", "risk_reasons",
        F.concat("city", F.lit("/"), "country", F.lit(" via "), "device_type").alias("detail"))
    return a.unionByName(b)
