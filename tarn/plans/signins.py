"""Sign-in features: time, travel, authentication and behaviour of every login."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions.geo import geo_velocity, haversine
from tarn.functions.times import time_parts
from tarn.functions.values import clip, fill
from tarn.operators.aggregates import known_device_pairs, user_baselines
from tarn.operators.joins import lookup, unknown_location
from tarn.operators.sequences import count_recent, minutes_between, with_previous

MODEL_FEATURES = [
    "hour_sin", "hour_cos", "is_weekend", "is_off_hours", "minutes_since_last_login", "distance_from_prev_km",
    "geo_velocity_kmh", "is_unknown_location", "failed_attempts_before", "mfa_numeric", "session_duration_min",
    "session_duration_zscore", "is_new_device", "logins_last_hour",
]
MAX_VELOCITY = 50_000.0


def with_travel(df: DataFrame, default: float | None = None) -> DataFrame:
    """Gap, distance and speed since the user's previous login; ``default`` for the first one."""
    out = with_previous(df, ["ts", "latitude", "longitude"])
    minutes = minutes_between("prev_ts", "ts")
    km = haversine(F.col("prev_latitude"), F.col("prev_longitude"), F.col("latitude"), F.col("longitude"), default)
    return out.withColumns({"minutes_since_last_login": minutes, "distance_from_prev_km": km}).withColumn(
        "geo_velocity_kmh", geo_velocity(F.col("distance_from_prev_km"), F.col("minutes_since_last_login"), default)
    ).drop("prev_ts", "prev_latitude", "prev_longitude")


def with_baselines(df: DataFrame, cutoff: str, history: DataFrame | None = None) -> DataFrame:
    """Attach each user's baseline; users without one keep NULLs."""
    return lookup(df, user_baselines(history if history is not None else df, cutoff), ["user_id"])


def session_z(df: DataFrame) -> DataFrame:
    std = F.col("baseline_session_std")
    z = F.when(std > 0, (F.col("session_duration_min") - F.col("baseline_session_avg")) / std).otherwise(F.lit(0.0))
    return df.withColumn("session_duration_zscore", z)


def with_known_devices(df: DataFrame, cutoff: str, history: DataFrame | None = None) -> DataFrame:
    """1 unless the device is among the user's devices before the cutoff; unknown users count as new."""
    pairs = known_device_pairs(history if history is not None else df, cutoff).withColumn("_known", F.lit(1))
    out = lookup(df, pairs, ["user_id", "device"])
    return out.withColumn("is_new_device", F.when(F.col("_known") == 1, 0).otherwise(1)).drop("_known")


def signin_features(df: DataFrame, cutoff: str) -> DataFrame:
    """Feature and metadata columns of every login, missing values kept."""
    out = time_parts(with_travel(count_recent(df)))
    out = unknown_location(out, history=df)
    out = session_z(with_baselines(out, cutoff, df))
    out = with_known_devices(out, cutoff, df)
    out = out.withColumns({"mfa_numeric": F.when(F.col("mfa_used"), 1).otherwise(0),
                           "is_weekend": F.col("is_weekend").cast("int"), "is_off_hours": F.col("is_off_hours").cast("int")})
    return out.select(
        "login_id", "user_id", "ts", "hour", "day_of_week", "is_weekend", "is_off_hours", "hour_sin", "hour_cos",
        "minutes_since_last_login", "distance_from_prev_km", "geo_velocity_kmh", "is_unknown_location", "latitude",
        "longitude", "failed_attempts_before", "mfa_numeric", "session_duration_min", "session_duration_zscore",
        "is_new_device", "logins_last_hour", "location_name", "device", "ip_address", "_anomaly_type")


def model_matrix(features: DataFrame, keep: Sequence[str] = ("login_id", "user_id", "_anomaly_type"),
                 digits: int | None = 6) -> DataFrame:
    """The 14 model columns as doubles: NULL is 0 and the speed is capped."""
    filled = fill(features, {c: 0 for c in MODEL_FEATURES})
    filled = filled.withColumn("geo_velocity_kmh", clip("geo_velocity_kmh", hi=MAX_VELOCITY))
    cols = []
    for c in MODEL_FEATURES:
        v = F.col(c).cast("double")
        cols.append((F.round(v, digits) if digits is not None else v).alias(c))
    return filled.select(*keep, *cols)


def reference_lists(df: DataFrame, column: str, label: str = "_anomaly_type", k: int = 10) -> DataFrame:
    """Values seen in normal rows, or the ``k`` most frequent ones when no row is normal."""
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"), F.max(F.col(label) == "normal").alias("_normal"))
    some_normal = per_value.agg(F.coalesce(F.max("_normal"), F.lit(False)).alias("x")).scalar()
    frequent = per_value.orderBy(F.desc("_n"), column).limit(k).filter(~some_normal)
    return per_value.filter("_normal").select(column).unionByName(frequent.select(column))


def batch_features(df: DataFrame, locations: DataFrame, devices: DataFrame) -> DataFrame:
    """Reduced features for scoring a batch on its own: global lists, session z and missing columns are 0."""
    out = df if "hour" in df.columns else time_parts(df)
    out = lookup(out, locations.select("location_name").withColumn("_loc", F.lit(1)), ["location_name"])
    out = lookup(out, devices.select("device").withColumn("_dev", F.lit(1)), ["device"])
    out = out.withColumns({
        "is_unknown_location": F.when(F.col("_loc") == 1, 0).otherwise(1),
        "is_new_device": F.when(F.col("_dev") == 1, 0).otherwise(1),
        "mfa_numeric": F.col("mfa_used").cast("int"), "session_duration_zscore": F.lit(0.0)}).drop("_loc", "_dev")
    if "logins_last_hour" not in out.columns:
        out = out.withColumn("logins_last_hour", F.lit(1))
    missing = {c: F.lit(0.0) for c in MODEL_FEATURES if c not in out.columns}
    return model_matrix(out.withColumns(missing) if missing else out, ["login_id", "user_id"])
