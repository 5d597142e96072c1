"""Queries over sign-ins: features, profiles, joins, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.catalog.adapters_sql import CUTOFF, FEATURES, SEQ, SIGNINS, MATRIX, MATRIX_COLUMNS
from tarn.catalog.registry import big, query, r6
from tarn.functions.geo import haversine
from tarn.functions.times import time_parts
from tarn.operators import aggregates as agg
from tarn.operators import joins as jn
from tarn.operators import sequences as seq
from tarn.operators.quantiles import summary_stats
from tarn.plans import signins as sg
from tarn.session import cut_lineage
from tarn.sources import adapters as ad
from tarn.sources.adapters import KNOWN_CITIES


def signins(spark, d):
    return ad.signins(spark, d)


def features(spark, d):
    return sg.signin_features(signins(spark, d), CUTOFF)


def matrix(spark, d, columns=None):
    """Model columns (or only some of them), stored once because the queries below pass over them several times."""
    m = sg.model_matrix(features(spark, d))
    return cut_lineage(m if columns is None else m.select("login_id", *columns))


# --- scalar features ----------------------------------------------------------

@query("fn_time_parts", f"WITH {SIGNINS} SELECT login_id, hour, day_of_week, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date,"
       " day_of_week IN (1, 7) AS is_weekend, hour < 7 OR hour > 19 AS is_off_hours, epoch_s AS epoch FROM signins")
def _(spark, d):
    return time_parts(signins(spark, d)).select("login_id", "hour", "day_of_week", "event_date", "is_weekend", "is_off_hours", "epoch")


@query("fn_cyclic_hour", f"WITH {SIGNINS} SELECT login_id, {r6('sin(2 * pi() * hour / 24)', 'hour_sin')},"
       f" {r6('cos(2 * pi() * hour / 24)', 'hour_cos')} FROM signins")
def _(spark, d):
    return time_parts(signins(spark, d)).select("login_id", "hour_sin", "hour_cos")


@query("fn_haversine", f"WITH {SIGNINS} SELECT login_id, " + r6(
    "12742.0 * asin(sqrt(least(1.0, pow(sin(radians(latitude - 39.53) / 2), 2) + cos(radians(39.53)) * cos(radians(latitude))"
    " * pow(sin(radians(longitude + 119.75) / 2), 2))))", "km") + " FROM signins")
def _(spark, d):
    km = haversine(F.lit(39.53), F.lit(-119.75), F.col("latitude"), F.col("longitude"))
    return signins(spark, d).select("login_id", km.alias("km"))


@query("fn_geo_velocity", f"WITH {SEQ} SELECT login_id, {r6('km', 'distance_from_prev_km')},"
       f" {r6('CASE WHEN gap_min > 0 THEN km / (gap_min / 60) END', 'geo_velocity_kmh')} FROM travel")
def _(spark, d):
    return sg.with_travel(signins(spark, d)).select("login_id", "distance_from_prev_km", "geo_velocity_kmh")


@query("win_lag_gap", f"WITH {SEQ} SELECT login_id, {r6('gap_min', 'minutes_since_last')} FROM travel")
def _(spark, d):
    return seq.with_gap(signins(spark, d)).select("login_id", "minutes_since_last")


@query("win_lag_position", f"WITH {SEQ} SELECT login_id, {r6('plat', 'prev_latitude')}, {r6('plon', 'prev_longitude')} FROM seq")
def _(spark, d):
    return seq.with_previous(signins(spark, d), ["latitude", "longitude"]).select("login_id", "prev_latitude", "prev_longitude")


@query("win_range_count", f"WITH {SIGNINS} SELECT login_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_s"
       " RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS logins_last_hour FROM signins")
def _(spark, d):
    return seq.count_recent(signins(spark, d)).select("login_id", "logins_last_hour")


FEATURE_SQL = ", ".join([
    "login_id", "user_id", "ts", "hour", "day_of_week", big("is_weekend"), big("is_off_hours"), r6("hour_sin"), r6("hour_cos"),
    r6("minutes_since_last_login"), r6("distance_from_prev_km"), r6("geo_velocity_kmh"), big("is_unknown_location"),
    r6("latitude"), r6("longitude"), "failed_attempts_before", big("mfa_numeric"), r6("session_duration_min"),
    r6("session_duration_zscore"), big("is_new_device"), "logins_last_hour", "location_name", "device", "ip_address",
    "_anomaly_type"])
query("fn_signin_features", f"WITH {FEATURES} SELECT {FEATURE_SQL} FROM feat")(features)


@query("fn_session_zscore", f"WITH {FEATURES} SELECT login_id, {r6('session_duration_zscore')} FROM feat")
def _(spark, d):
    return sg.session_z(sg.with_baselines(signins(spark, d), CUTOFF)).select("login_id", "session_duration_zscore")


NEW_DEVICE = f"WITH {FEATURES} SELECT login_id, user_id, device, CAST(is_new_device AS BIGINT) AS is_new_device FROM feat"


def new_device(spark, d):
    return sg.with_known_devices(signins(spark, d), CUTOFF).select("login_id", "user_id", "device", "is_new_device")


query("fn_new_device", NEW_DEVICE)(new_device)
query("join_known_devices", NEW_DEVICE)(new_device)


@query("join_known_locations", f"WITH {FEATURES} SELECT login_id, CAST(is_unknown_location AS BIGINT) AS is_unknown_location FROM feat")
def _(spark, d):
    return jn.unknown_location(signins(spark, d)).select("login_id", "is_unknown_location")


BASE_COLS = ["baseline_session_avg", "baseline_session_std", "baseline_failed_avg", "baseline_hour_avg", "baseline_hour_std"]
BASE_INTS = ["baseline_login_count", "baseline_device_count", "baseline_ip_count"]
BASE_SQL = ", ".join([*[r6(c) for c in BASE_COLS], *[big(c) for c in BASE_INTS]])


@query("join_user_baselines", f"WITH {FEATURES} SELECT s.login_id, {BASE_SQL} FROM signins s LEFT JOIN baseline b ON b.user_id = s.user_id")
def _(spark, d):
    return sg.with_baselines(signins(spark, d), CUTOFF).select("login_id", *BASE_COLS, *BASE_INTS)


@query("agg_user_baseline", f"WITH {FEATURES} SELECT user_id, {BASE_SQL} FROM baseline")
def _(spark, d):
    return agg.user_baselines(signins(spark, d), CUTOFF)


@query("agg_known_devices", f"WITH {FEATURES} SELECT user_id, string_agg(device, '|' ORDER BY device) AS known_devices FROM known_dev GROUP BY user_id")
def _(spark, d):
    return agg.known_devices(signins(spark, d), CUTOFF)


@query("od_batch_features", f"WITH {FEATURES}, dl AS (SELECT DISTINCT device FROM signins WHERE _anomaly_type = 'normal')"
       f" SELECT f.login_id, f.user_id, {r6('hour_sin')}, {r6('hour_cos')}, {r6('is_weekend')}, {r6('is_off_hours')},"
       " 0.0 + 0 AS minutes_since_last_login, 0.0 + 0 AS distance_from_prev_km, 0.0 + 0 AS geo_velocity_kmh,"
       f" {r6('is_unknown_location')}, {r6('failed_attempts_before')}, {r6('mfa_numeric')}, {r6('session_duration_min')},"
       " 0.0 + 0 AS session_duration_zscore, CAST(CASE WHEN dl.device IS NULL THEN 1 ELSE 0 END AS DOUBLE) AS is_new_device,"
       " CAST(1 AS DOUBLE) AS logins_last_hour FROM feat f LEFT JOIN dl ON dl.device = f.device".replace("0.0 + 0", "CAST(0 AS DOUBLE)"))
def _(spark, d):
    s = signins(spark, d)
    return sg.batch_features(s, sg.reference_lists(s, "location_name"), sg.reference_lists(s, "device"))


# --- profiles -----------------------------------------------------------------

@query("agg_profile_count", f"WITH {SIGNINS} SELECT count(*) AS total_rows, count(DISTINCT user_id) AS distinct_users,"
       " min(ts) AS first_ts, max(ts) AS last_ts FROM signins")
def _(spark, d):
    return agg.profile(signins(spark, d))


@query("agg_by_hour", f"WITH {SIGNINS} SELECT hour, count(*) AS n_events FROM signins GROUP BY hour")
def _(spark, d):
    return agg.by_hour(signins(spark, d))


@query("agg_by_dow", f"WITH {SIGNINS} SELECT day_of_week, count(*) AS n_events FROM signins GROUP BY day_of_week")
def _(spark, d):
    return agg.by_dow(signins(spark, d))


@query("agg_heatmap", f"WITH {SIGNINS} SELECT day_of_week, "
       + ", ".join(f"count(*) FILTER (hour = {h}) AS h{h}" for h in range(24)) + " FROM signins GROUP BY day_of_week")
def _(spark, d):
    return agg.hour_dow_matrix(signins(spark, d))


@query("agg_by_location", f"WITH {SIGNINS} SELECT location_name, count(*) AS login_count, count(DISTINCT user_id) AS unique_users,"
       f" {r6('avg(session_duration_min)', 'avg_session_min')} FROM signins GROUP BY location_name")
def _(spark, d):
    return agg.by_location(signins(spark, d))


@query("agg_geo_points", f"WITH {SIGNINS} SELECT latitude, longitude, starts_with(location_name, 'Site_') AS is_known,"
       " count(*) AS n_events FROM signins GROUP BY ALL")
def _(spark, d):
    return agg.geo_points(signins(spark, d), KNOWN_CITIES)


@query("agg_failed_hist", f"WITH {SIGNINS} SELECT failed_attempts_before, count(*) AS n_events FROM signins GROUP BY 1")
def _(spark, d):
    return agg.failed_hist(signins(spark, d))


@query("agg_mfa_usage", f"WITH {SIGNINS} SELECT mfa_used, count(*) AS n_events, count(DISTINCT user_id) AS unique_users FROM signins GROUP BY 1")
def _(spark, d):
    return agg.mfa_usage(signins(spark, d))


@query("agg_by_device", f"WITH {SIGNINS} SELECT device, count(*) AS login_count, count(DISTINCT user_id) AS unique_users,"
       f" {r6('avg(failed_attempts_before)', 'avg_failed_attempts')} FROM signins GROUP BY device")
def _(spark, d):
    return agg.by_device(signins(spark, d))


@query("agg_user_profile", f"WITH {SIGNINS} SELECT user_id, count(*) AS total_logins, {r6('avg(hour)', 'avg_login_hour')},"
       f" {r6('stddev_samp(hour)', 'std_login_hour')}, count(DISTINCT location_name) AS unique_locations,"
       f" count(DISTINCT device) AS unique_devices, count(DISTINCT ip_address) AS unique_ips,"
       f" {r6('avg(session_duration_min)', 'avg_session_min')}, {r6('avg(failed_attempts_before)', 'avg_failed_attempts')},"
       f" {r6('avg(CASE WHEN mfa_used THEN 1 ELSE 0 END)', 'mfa_rate')} FROM signins GROUP BY user_id")
def _(spark, d):
    return agg.user_profiles(signins(spark, d))


@query("agg_summary_stats", f"WITH {MATRIX}, long AS (UNPIVOT mat ON {', '.join(MATRIX_COLUMNS)} INTO NAME feature VALUE value)"
       f" SELECT feature, count(*) AS n, {r6('avg(value)', 'mean')}, {r6('stddev_samp(value)', 'std')}, {r6('min(value)', 'min')},"
       f" {r6('max(value)', 'max')}, {r6('quantile_cont(value, 0.25)', 'p25')}, {r6('quantile_cont(value, 0.5)', 'p50')},"
       f" {r6('quantile_cont(value, 0.75)', 'p75')} FROM long GROUP BY feature")
def _(spark, d):
    return summary_stats(matrix(spark, d), sg.MODEL_FEATURES)


@query("agg_bucket_metrics", f"WITH {SIGNINS} SELECT to_timestamp(epoch_s // 300 * 300)::TIMESTAMP AS bucket_ts, count(*) AS total_logins,"
       " count(DISTINCT user_id) AS distinct_users, count(DISTINCT ip_address) AS distinct_ips,"
       f" {r6('avg(failed_attempts_before)', 'avg_failed_attempts_before')},"
       f" {r6('avg(CASE WHEN failed_attempts_before > 0 THEN 1 ELSE 0 END)', 'failure_rate')},"
       f" {r6('avg(CASE WHEN mfa_used THEN 1 ELSE 0 END)', 'mfa_rate')},"
       f" {r6('avg(CASE WHEN hour < 7 OR hour > 19 THEN 1 ELSE 0 END)', 'off_hours_share')},"
       f" {r6('avg(CASE WHEN success THEN 1 ELSE 0 END)', 'success_rate')} FROM signins GROUP BY 1")
def _(spark, d):
    return agg.bucket_metrics(signins(spark, d))


@query("agg_crosstab", f"WITH {SIGNINS} SELECT device, _anomaly_type, count(*) AS n_rows,"
       f" {r6('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY device)', 'row_pct')} FROM signins GROUP BY device, _anomaly_type")
def _(spark, d):
    return agg.crosstab(signins(spark, d), "device", "_anomaly_type", normalize=True)


@query("set_distinct", f"WITH {SIGNINS} SELECT DISTINCT location_name FROM signins")
def _(spark, d):
    return seq.distinct_values(signins(spark, d), "location_name")


@query("srt_seeded_sample", f"WITH {SIGNINS} SELECT login_id, user_id, device FROM signins ORDER BY md5(concat(login_id, '-42')), login_id LIMIT 100")
def _(spark, d):
    return seq.hash_sample(signins(spark, d), "login_id", 100).select("login_id", "user_id", "device")
