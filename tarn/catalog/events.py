"""Queries over scored message and sign-in events, alerts and pipeline health."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.catalog.adapters_sql import EMAILS, EVENTS, HEALTH
from tarn.catalog.registry import mean3, query, r6
from tarn.functions import rules
from tarn.functions.texts import clean_text, word_count
from tarn.functions.values import tier, tier_right, tier_z
from tarn.operators import aggregates as agg
from tarn.operators import quality as dq
from tarn.operators import sequences as seq
from tarn.plans import events as ev
from tarn.plans import messages as msg
from tarn.plans import monitoring as mon
from tarn.sources import adapters as ad

NOW = "2024-02-01 00:00:00"
LIMITS = mon.Thresholds(min_row_count=60, max_null_rate=0.03, max_processing_seconds=80.0, max_staleness_hours=240.0)


def now():
    return F.lit(NOW).cast("timestamp")


def email_scores(spark, d):
    return ev.email_scores(ad.email_events(spark, d))


def signin_scores(spark, d):
    return ev.signin_scores(ad.signin_events(spark, d))


def alerts(spark, d):
    return ev.security_alerts(email_scores(spark, d), signin_scores(spark, d))


# --- message columns ----------------------------------------------------------

@query("fn_text_lengths", f"WITH {EMAILS} SELECT email_id, CAST(length(body) AS BIGINT) AS body_length,"
       " CAST(len(string_split_regex(body, '\\s+')) AS BIGINT) AS word_count, CAST(length(subject) AS BIGINT) AS subject_length FROM emails")
def _(spark, d):
    return msg.text_stats(ad.emails(spark, d)).select("email_id", "body_length", "word_count", "subject_length")


@query("fn_clean_text", f"WITH {EMAILS} SELECT email_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
       "lower(coalesce(body, '')), 'http\\S+|www\\.\\S+', ' ', 'g'), '\\S+@\\S+\\.\\S+', ' ', 'g'), '[^a-z0-9\\s]', ' ', 'g'),"
       " '\\s+', ' ', 'g'))) AS clean_md5 FROM emails")
def _(spark, d):
    return ad.emails(spark, d).select("email_id", F.md5(clean_text("body")).alias("clean_md5"))


@query("fn_text_misc", f"WITH {EMAILS} SELECT email_id, concat_ws('; ', substr(body, 1, 10), CASE WHEN has_attachment THEN"
       " concat('files:', attachment_count) END, upper(sender)) AS note FROM emails")
def _(spark, d):
    return ad.emails(spark, d).select("email_id", F.concat_ws(
        "; ", F.substring("body", 1, 10), F.when(F.col("has_attachment"), F.concat(F.lit("files:"), "attachment_count")),
        F.upper("sender")).alias("note"))


@query("fn_log_size", f"WITH {EMAILS}, b AS (SELECT min(ln(1 + size_mb)) AS lo, max(ln(1 + size_mb)) AS hi FROM emails)"
       f" SELECT email_id, {r6('(ln(1 + size_mb) - lo) / (hi - lo) * 0.7 + CASE WHEN has_attachment THEN 0.3 ELSE 0 END', 'attachment_signal')}"
       " FROM emails, b")
def _(spark, d):
    return msg.attachment_signal_log(ad.emails(spark, d)).select("email_id", "attachment_signal")


@query("fn_direction", f"WITH {EVENTS} SELECT event_id, is_external_sender, is_external_recipient, direction FROM silver_email")
def _(spark, d):
    return ev.direction(ad.email_events(spark, d)).select("event_id", "is_external_sender", "is_external_recipient", "direction")


@query("fn_known_place", f"WITH {EVENTS} SELECT event_id, is_known_location, _dq_impossible_coords FROM silver_signin")
def _(spark, d):
    return ev.place_flags(ad.signin_events(spark, d)).select("event_id", "is_known_location", "_dq_impossible_coords")


@query("dq_flags", f"WITH {EVENTS} SELECT 'email' AS kind, event_id, _dq_missing_subject AS flag_a, _dq_missing_sender AS flag_b,"
       " _dq_oversized AS flag_c FROM silver_email UNION ALL"
       " SELECT 'signin', event_id, _dq_missing_user, _dq_impossible_coords, NULL FROM silver_signin")
def _(spark, d):
    a = ev.dq_flags_email(ad.email_events(spark, d)).select(
        F.lit("email").alias("kind"), "event_id", F.col("_dq_missing_subject").alias("flag_a"),
        F.col("_dq_missing_sender").alias("flag_b"), F.col("_dq_oversized").alias("flag_c"))
    b = ev.dq_flags_signin(ad.signin_events(spark, d)).select(
        F.lit("signin").alias("kind"), "event_id", F.col("_dq_missing_user").alias("flag_a"),
        F.col("_dq_impossible_coords").alias("flag_b"), F.lit(None).cast("boolean").alias("flag_c"))
    return a.unionByName(b)


@query("dq_summary_email", f"WITH {EVENTS} SELECT count(*) AS total_events, count(*) FILTER (_dq_missing_subject) AS missing_subject,"
       " count(*) FILTER (_dq_missing_sender) AS missing_sender, count(*) FILTER (_dq_oversized) AS oversized_emails,"
       " count(*) FILTER (is_off_hours) AS off_hours_emails, count(*) FILTER (is_external_sender) AS external_sender,"
       " count(*) FILTER (is_external_recipient) AS external_recipient FROM silver_email")
def _(spark, d):
    return dq.email_quality(ev.silver_email(ad.email_events(spark, d)))


@query("dq_summary_signin", f"WITH {EVENTS} SELECT count(*) AS total_events, count(*) FILTER (login_success) AS successful_logins,"
       " count(*) FILTER (NOT login_success) AS failed_logins, count(*) FILTER (is_off_hours) AS off_hours,"
       " count(*) FILTER (NOT is_known_location) AS unknown_locations, count(*) FILTER (NOT mfa_used) AS no_mfa,"
       " count(*) FILTER (geo_velocity_kmh > 900) AS impossible_travel,"
       f" {r6('round(avg(geo_velocity_kmh), 1)', 'avg_geo_velocity_kmh')}, {r6('round(max(geo_velocity_kmh), 1)', 'max_geo_velocity_kmh')}"
       " FROM silver_signin")
def _(spark, d):
    return dq.signin_quality(ev.silver_signin(ad.signin_events(spark, d)))


# --- rules --------------------------------------------------------------------

def email_rule(name, columns, doubles):
    sql = ", ".join(["event_id", *columns, *[r6(c) for c in doubles]])

    @query(name, f"WITH {EVENTS} SELECT {sql} FROM email_scores")
    def _(spark, d):
        return rules.email_risk(ev.silver_email(ad.email_events(spark, d))).select("event_id", *columns, *doubles)


def signin_rule(name, columns, doubles):
    sql = ", ".join(["event_id", *columns, *[r6(c) for c in doubles]])

    @query(name, f"WITH {EVENTS} SELECT {sql} FROM signin_scores")
    def _(spark, d):
        return rules.signin_risk(ev.silver_signin(ad.signin_events(spark, d))).select("event_id", *columns, *doubles)


email_rule("rule_email_keyword", ["keyword_category"], ["keyword_signal"])
email_rule("rule_email_attachment", ["has_attachment"], ["attachment_signal"])
email_rule("rule_email_direction", ["direction"], ["direction_signal"])
email_rule("rule_email_temporal", ["is_off_hours", "is_weekend"], ["temporal_signal"])
email_rule("rule_email_score", ["risk_tier", "risk_reasons"], ["risk_score"])
signin_rule("rule_signin_geo", [], ["geo_velocity_kmh", "geo_signal"])
signin_rule("rule_signin_auth", ["failed_attempts"], ["auth_signal"])
signin_rule("rule_signin_place_device", ["is_known_location", "device_type"], ["location_device_signal"])
signin_rule("rule_signin_mfa", ["is_off_hours", "mfa_used"], ["temporal_mfa_signal"])
signin_rule("rule_signin_score", ["risk_tier", "risk_reasons"], ["risk_score"])


@query("tier_left_closed", f"WITH {EMAILS} SELECT email_id, CASE WHEN v >= 0.8 THEN 'Critical' WHEN v >= 0.6 THEN 'High'"
       " WHEN v >= 0.3 THEN 'Medium' ELSE 'Low' END AS tier FROM (SELECT email_id, CAST(email_id % 11 AS DOUBLE) / 10 AS v FROM emails)")
def _(spark, d):
    return ad.emails(spark, d).select("email_id", tier(F.col("email_id") % 11 / F.lit(10.0)).alias("tier"))


@query("tier_right_closed", f"WITH {EMAILS} SELECT email_id, CASE WHEN v <= 0.3 THEN 'Low' WHEN v <= 0.6 THEN 'Medium'"
       " WHEN v <= 0.8 THEN 'High' ELSE 'Critical' END AS tier FROM (SELECT email_id, CAST(email_id % 11 AS DOUBLE) / 10 AS v FROM emails)")
def _(spark, d):
    return ad.emails(spark, d).select("email_id", tier_right(F.col("email_id") % 11 / F.lit(10.0)).alias("tier"))


@query("tier_zscore", f"WITH {EMAILS} SELECT email_id, CASE WHEN email_id % 10 < 3 THEN 'low' WHEN email_id % 10 < 5 THEN 'medium'"
       " WHEN email_id % 10 < 8 THEN 'high' ELSE 'critical' END AS tier FROM emails")
def _(spark, d):
    return ad.emails(spark, d).select("email_id", tier_z((F.col("email_id") % 10).cast("double")).alias("tier"))


# --- alerts -------------------------------------------------------------------

@query("set_alerts_union", f"WITH {EVENTS} SELECT event_id, timestamp, event_type, principal, {r6('risk_score')}, risk_tier,"
       " risk_reasons, detail FROM alerts")
def _(spark, d):
    return alerts(spark, d)


@query("agg_alert_counts", f"WITH {EVENTS} SELECT event_type, risk_tier, count(*) AS alert_count FROM alerts GROUP BY ALL")
def _(spark, d):
    return agg.alert_counts(alerts(spark, d))


@query("srt_top_k", f"WITH {EVENTS} SELECT event_id, event_type, risk_tier, {r6('risk_score')} FROM signin_alerts"
       " ORDER BY signin_alerts.risk_score DESC, event_id LIMIT 20".replace("signin_alerts", "alerts"))
def _(spark, d):
    rounded = alerts(spark, d).select("event_id", "event_type", "risk_tier", F.round("risk_score", 6).alias("risk_score"))
    return rounded.orderBy(F.desc("risk_score"), "event_id", "event_type").limit(20)


@query("agg_risk_summary", f"WITH {EVENTS}, both_scores AS (SELECT 'email' AS event_type, risk_tier, risk_score, timestamp FROM email_scores"
       " UNION ALL SELECT 'signin', risk_tier, risk_score, timestamp FROM signin_scores)"
       f" SELECT event_type, risk_tier, count(*) AS alert_count, {mean3('risk_score', 'avg_score')},"
       " max(timestamp) AS latest_alert FROM both_scores GROUP BY event_type, risk_tier")
def _(spark, d):
    return agg.risk_summary(email_scores(spark, d), signin_scores(spark, d))


@query("agg_tier_distribution", f"WITH {EVENTS} SELECT risk_tier, count(*) AS n_rows, {r6('avg(risk_score)', 'avg_score')},"
       f" {r6('min(risk_score)', 'min_score')}, {r6('max(risk_score)', 'max_score')}, count(*) FILTER (NOT login_success) AS failed_logins,"
       " count(*) FILTER (NOT mfa_used) AS no_mfa FROM signin_scores GROUP BY risk_tier")
def _(spark, d):
    return agg.tier_distribution(signin_scores(spark, d), counters={
        "failed_logins": ~F.col("login_success"), "no_mfa": ~F.col("mfa_used")})


@query("agg_user_risk_profile", f"WITH {EVENTS} SELECT user_id, count(*) AS total_signins,"
       " count(*) FILTER (risk_tier IN ('Critical', 'High')) AS high_risk_events,"
       f" {mean3('risk_score', 'avg_risk_score')}, {r6('round(max(risk_score), 3)', 'max_risk_score')},"
       " string_agg(DISTINCT city, '|' ORDER BY city) AS cities, string_agg(DISTINCT device_type, '|' ORDER BY device_type) AS devices,"
       " count(*) FILTER (NOT mfa_used) AS no_mfa_count, CAST(sum(failed_attempts) AS BIGINT) AS total_failed_attempts,"
       f" {r6('round(max(geo_velocity_kmh), 0)', 'max_geo_velocity_kmh')} FROM signin_scores WHERE user_id = 7 GROUP BY user_id")
def _(spark, d):
    return agg.user_risk_profile(signin_scores(spark, d), 7)


@query("agg_daily_tiers", f"WITH {EVENTS} SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS day, risk_tier, count(*) AS event_count,"
       f" count(DISTINCT user_id) AS unique_users, {mean3('risk_score', 'avg_score')} FROM signin_scores GROUP BY 1, 2")
def _(spark, d):
    return agg.daily_tiers(signin_scores(spark, d), "timestamp")


@query("win_top_per_group", f"WITH {EVENTS} SELECT * FROM (SELECT event_id, risk_tier, {r6('risk_score')}, row_number() OVER"
       " (PARTITION BY risk_tier ORDER BY round(signin_scores.risk_score, 6) DESC, event_id) AS rank FROM signin_scores) WHERE rank <= 3")
def _(spark, d):
    s = signin_scores(spark, d).select("event_id", "risk_tier", F.round("risk_score", 6).alias("risk_score"))
    return seq.top_per_group(s, ["risk_tier"], [F.desc("risk_score"), F.asc("event_id")], 3)


@query("agg_size_hist", f"WITH {EMAILS} SELECT has_attachment, CAST(least(19, greatest(0, floor((size_mb - 0) / 5))) AS BIGINT) AS bin,"
       f" count(*) AS n_rows, {r6('least(19, greatest(0, floor((size_mb - 0) / 5))) * 5', 'bin_start')} FROM emails GROUP BY ALL")
def _(spark, d):
    return agg.histogram(ad.emails(spark, d), "size_mb", 0, 100, 20, ["has_attachment"])


@query("agg_attachment_by_label", f"WITH {EMAILS} SELECT _label, count(*) AS email_count,"
       f" {r6('avg(CASE WHEN has_attachment THEN 1 ELSE 0 END)', 'attachment_rate')}, {r6('avg(attachment_count)', 'avg_attachments')},"
       f" {r6('avg(size_mb)', 'avg_size_mb')}, {r6('max(size_mb)', 'max_size_mb')} FROM emails GROUP BY _label")
def _(spark, d):
    return agg.attachment_stats(ad.emails(spark, d))


@query("agg_extension_freq", f"WITH {EMAILS}, files AS (SELECT unnest(string_split(attachment_names, '|')) AS filename FROM emails"
       " WHERE attachment_names IS NOT NULL) SELECT regexp_extract(filename, '\\.([^.]+)$', 1) AS extension, count(*) AS n_files"
       " FROM files GROUP BY 1")
def _(spark, d):
    return agg.extension_freq(ad.emails(spark, d))


@query("agg_sender_activity", f"WITH {EMAILS} SELECT sender, count(*) AS email_count,"
       f" {r6('avg(len(string_split_regex(body, chr(92) || chr(115) || chr(43))))', 'avg_word_count')} FROM emails GROUP BY sender"
       " ORDER BY email_count DESC, sender LIMIT 20")
def _(spark, d):
    return agg.sender_activity(ad.emails(spark, d))


@query("agg_health_row", f"WITH {EVENTS} SELECT 'bronze_to_silver' AS pipeline_stage, 'signin' AS event_type,"
       f" TIMESTAMP '{NOW}' AS run_timestamp, count(*) AS row_count,"
       " count(*) FILTER (event_id IS NULL) + count(*) FILTER (timestamp IS NULL) AS null_count,"
       " CAST(0 AS DOUBLE) AS null_rate, min(timestamp) AS min_event_ts, max(timestamp) AS max_event_ts,"
       " CAST(12.5 AS DOUBLE) AS processing_seconds, 'success' AS status FROM silver_signin")
def _(spark, d):
    return agg.health_row(ev.silver_signin(ad.signin_events(spark, d)), "bronze_to_silver", "signin", now(), 12.5)


# --- monitoring ---------------------------------------------------------------

_FLAGGED = (HEALTH + f""",
flags AS (SELECT *, row_count < 60 AS is_low_volume, null_rate > 0.03 AS is_high_null_rate, processing_seconds > 80 AS is_slow,
  (epoch(TIMESTAMP '{NOW}') - floor(epoch(max_event_ts))) / 3600 > 240 AS is_stale FROM health),
flagged AS (SELECT *, is_low_volume OR is_high_null_rate OR is_slow OR is_stale AS has_anomaly, concat_ws('; ',
  CASE WHEN is_low_volume THEN concat('low_volume:', row_count) END,
  CASE WHEN is_high_null_rate THEN concat('high_null_rate:', round(null_rate, 4)) END,
  CASE WHEN is_slow THEN concat('slow_processing:', round(processing_seconds, 1), 's') END,
  CASE WHEN is_stale THEN 'stale_data' END) AS anomaly_reasons FROM flags)""")


@query("mon_flags", f"WITH {_FLAGGED} SELECT event_type, run_timestamp, is_low_volume, is_high_null_rate, is_slow, is_stale,"
       " has_anomaly FROM flagged")
def _(spark, d):
    return mon.health_flags(ad.health(spark, d), LIMITS, now()).select(
        "event_type", "run_timestamp", "is_low_volume", "is_high_null_rate", "is_slow", "is_stale", "has_anomaly")


@query("mon_reasons", f"WITH {_FLAGGED} SELECT event_type, run_timestamp, anomaly_reasons FROM flagged")
def _(spark, d):
    return mon.health_reasons(mon.health_flags(ad.health(spark, d), LIMITS, now())).select(
        "event_type", "run_timestamp", "anomaly_reasons")


@query("mon_anomalies", f"WITH {_FLAGGED} SELECT pipeline_stage, event_type, run_timestamp, row_count, {r6('null_rate')}, anomaly_reasons"
       " FROM flagged WHERE has_anomaly")
def _(spark, d):
    return mon.pipeline_anomalies(ad.health(spark, d), LIMITS, now()).select(
        "pipeline_stage", "event_type", "run_timestamp", "row_count", "null_rate", "anomaly_reasons")


@query("mon_injected_fault", f"WITH {HEALTH}, plus AS (SELECT event_type, run_timestamp, row_count, null_rate, processing_seconds FROM health"
       " UNION ALL SELECT 'injected', TIMESTAMP '2024-02-01', 12, 0.42, 0.3)"
       " SELECT event_type, run_timestamp, CAST(row_count AS BIGINT) AS row_count, row_count < 60 OR null_rate > 0.03 OR processing_seconds > 80"
       " AS has_anomaly FROM plus")
def _(spark, d):
    return mon.health_flags(mon.with_injected_fault(ad.health(spark, d)), LIMITS, now(), stale=False).select(
        "event_type", "run_timestamp", "row_count", "has_anomaly")


@query("win_latest_per_key", f"WITH {HEALTH} SELECT pipeline_stage, event_type, row_count, {r6('round(null_rate, 4)', 'null_rate')},"
       f" {r6('round(processing_seconds, 1)', 'processing_seconds')}, status, run_timestamp,"
       f" {r6(f'''round((epoch(TIMESTAMP '{NOW}') - floor(epoch(max_event_ts))) / 3600, 1)''', 'hours_since_latest_data')}"
       " FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_stage, event_type ORDER BY run_timestamp DESC) AS rn FROM health)"
       " WHERE rn = 1")
def _(spark, d):
    return mon.pipeline_status(ad.health(spark, d), now())
