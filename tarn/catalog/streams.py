"""Queries that run a stream to completion over the given tables and read the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.catalog.adapters_sql import CUTOFF, EVENTS, FEATURES, MATRIX, MATRIX_COLUMNS, ORDERS, SIGNINS
from tarn.catalog.orders import EVENT_ROWS, ORDER_COLUMNS, event_rows
from tarn.catalog.registry import SQL, query, r6
from tarn.catalog.signin import signins
from tarn.operators.ensemble import composite_risk, fit_composite
from tarn.operators.tails import fit_tails, tail_scores
from tarn.plans import events as ev
from tarn.plans import scoring
from tarn.plans import signins as sg
from tarn.session import cut_lineage, scratch_path
from tarn.sources import adapters as ad
from tarn.sources import files as fl
from tarn.sources import tables as tb
from tarn.streaming import increments, ingest, user_state, windows

EVENT_SCHEMA = "event_id long, user_id long, event_type string, value double"


def landed(spark, d):
    path = scratch_path(spark, "landing")
    event_rows(spark, d).write.json(path)
    return path


def ingested(spark, d):
    out = scratch_path(spark, "bronze")
    ingest.ingest_stream(spark, landed(spark, d), EVENT_SCHEMA, out, scratch_path(spark, "ckpt"))
    return spark.read.parquet(out)


@query("src_json_stream", EVENT_ROWS)
def _(spark, d):
    out = scratch_path(spark, "stream")
    ingest.stream_to(fl.json_stream(spark, landed(spark, d), EVENT_SCHEMA), out, scratch_path(spark, "ckpt"))
    return spark.read.parquet(out)


@query("src_schema_inference", EVENT_ROWS)
def _(spark, d):
    out = scratch_path(spark, "inferred")
    stream = fl.json_stream_inferred(spark, landed(spark, d), scratch_path(spark, "schema"))
    ingest.stream_to(stream, out, scratch_path(spark, "ckpt"))
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


@query("src_ingest_lineage", "SELECT count(*) AS n_rows, count(*) AS with_time, count(*) AS with_file FROM events")
def _(spark, d):
    return ingested(spark, d).agg(F.count(F.lit(1)).alias("n_rows"), F.count("_ingested_at").alias("with_time"),
                                  F.count("_source_file").alias("with_file"))


@query("st_ingest", EVENT_ROWS)
def _(spark, d):
    return ingested(spark, d).select("event_id", "user_id", "event_type", "value")


@query("src_stream_table", EVENT_ROWS)
def _(spark, d):
    source, out = scratch_path(spark, "table"), scratch_path(spark, "copied")
    tb.write_table(event_rows(spark, d), source)
    ingest.stream_to(fl.stream_table(spark, source, EVENT_SCHEMA), out, scratch_path(spark, "ckpt"))
    return spark.read.parquet(out)


@query("sink_stream_append", EVENT_ROWS)
def _(spark, d):
    """Two runs over a growing source: the second adds only the new rows."""
    source, out, ckpt = scratch_path(spark, "grow"), scratch_path(spark, "out"), scratch_path(spark, "ckpt")
    rows = event_rows(spark, d)
    tb.write_table(rows.filter("event_type = 'error'"), source)
    ingest.stream_to(fl.stream_table(spark, source, EVENT_SCHEMA), out, ckpt)
    tb.write_table(rows.filter("event_type <> 'error'"), source, "append")
    ingest.stream_to(fl.stream_table(spark, source, EVENT_SCHEMA), out, ckpt)
    return spark.read.parquet(out)


@query("st_silver_orders", f"WITH {ORDERS} SELECT {ORDER_COLUMNS} FROM silver_orders")
def _(spark, d):
    source, out = scratch_path(spark, "raw_orders"), scratch_path(spark, "silver_orders")
    raw = ad.orders_raw(spark, d)
    tb.write_table(raw, source)
    ingest.silver_orders_stream(spark, source, raw.schema, out, scratch_path(spark, "ckpt"))
    return spark.read.parquet(out)


@query("st_silver_violations", SQL["dq_metrics"])
def _(spark, d):
    """Violation counts of two micro-batches, kept by the listener and summed per rule."""
    source, log = scratch_path(spark, "raw_orders"), scratch_path(spark, "violations")
    out, ckpt = scratch_path(spark, "silver_orders"), scratch_path(spark, "ckpt")
    raw = ad.orders_raw(spark, d)
    half = F.pmod(F.xxhash64(*raw.columns), F.lit(2)) == 0
    for part in (raw.filter(half), raw.filter(~half)):
        tb.write_table(part, source, "append")
        ingest.silver_orders_stream(spark, source, raw.schema, out, ckpt, log)
    return spark.read.parquet(log).groupBy("rule", "action").agg(F.sum("violations").alias("violations"))


@query("st_bucket_metrics", f"WITH {SIGNINS}, late AS (SELECT max(ts) - INTERVAL 10 MINUTES AS w FROM signins)"
       " SELECT make_timestamp(epoch_s // 300 * 300 * 1000000) AS bucket_ts, count(*) AS total_logins, count(DISTINCT user_id) AS distinct_users,"
       f" count(DISTINCT ip_address) AS distinct_ips, {r6('avg(failed_attempts_before)', 'avg_failed_attempts_before')},"
       f" {r6('avg(CASE WHEN failed_attempts_before > 0 THEN 1 ELSE 0 END)', 'failure_rate')},"
       f" {r6('avg(CASE WHEN mfa_used THEN 1 ELSE 0 END)', 'mfa_rate')},"
       f" {r6('avg(CASE WHEN hour < 7 OR hour > 19 THEN 1 ELSE 0 END)', 'off_hours_share')},"
       f" {r6('avg(CASE WHEN success THEN 1 ELSE 0 END)', 'success_rate')} FROM signins GROUP BY 1"
       " HAVING bucket_ts + INTERVAL 5 MINUTES <= (SELECT w FROM late)")
def _(spark, d):
    source, out = scratch_path(spark, "signins"), scratch_path(spark, "buckets")
    rows = signins(spark, d)
    tb.write_table(rows, source)
    stream = windows.bucket_metrics_stream(fl.stream_table(spark, source, rows.schema))
    ingest.stream_to(stream, out, scratch_path(spark, "ckpt"))
    return spark.read.parquet(out)


@query("st_user_features", f"WITH {FEATURES} SELECT login_id, user_id, {r6('minutes_since_last_login')}, {r6('distance_from_prev_km')},"
       f" {r6('geo_velocity_kmh')}, CAST(logins_last_hour AS BIGINT) AS logins_last_hour, CAST(is_new_device AS BIGINT) AS is_new_device FROM feat")
def _(spark, d):
    source, out = scratch_path(spark, "signins"), scratch_path(spark, "features")
    rows = signins(spark, d)
    tb.write_table(rows, source)
    stream = user_state.user_features_stream(fl.stream_table(spark, source, rows.schema), CUTOFF)
    ingest.stream_to(stream, out, scratch_path(spark, "ckpt"), **user_state.SETTINGS)
    return spark.read.parquet(out).select("login_id", "user_id", "minutes_since_last_login", "distance_from_prev_km",
                                          "geo_velocity_kmh", "logins_last_hour", "is_new_device")


@query("st_score_messages", f"WITH {EVENTS} SELECT event_id, {r6('risk_score')}, risk_tier, count(*) OVER () AS n_rows FROM email_scores")
def _(spark, d):
    """Two increments give every row one score, as a single run would."""
    out = scratch_path(spark, "scores")
    events = ad.email_events(spark, d)
    half = events.filter(F.col("timestamp") <= F.lit("2025-01-10").cast("timestamp"))
    increments.score_increment(half, out, ev.email_scores, "timestamp")
    increments.score_increment(events, out, ev.email_scores, "timestamp")
    increments.score_increment(events, out, ev.email_scores, "timestamp")
    done = spark.read.parquet(out)
    return done.select("event_id", "risk_score", "risk_tier", done.agg(F.count(F.lit(1)).alias("n")).scalar().alias("n_rows"))


# --- stored composite models --------------------------------------------------

SPLITS = ("2024-01-15", "2024-01-22")


def scored_in_increments(spark, d, parts_of, scorer):
    """Fit on rows before the first split, store the model, score what follows in two runs of a stream; a third run finds nothing new."""
    rows = cut_lineage(sg.model_matrix(sg.signin_features(signins(spark, d), CUTOFF), ["login_id", "user_id", "ts"]))
    first, second = [F.lit(x).cast("timestamp") for x in SPLITS]
    store = scoring.ModelStore(spark, scratch_path(spark, "models"))
    train = rows.filter(F.col("ts") < first)
    store.save(parts_of(train), train)
    source, out, ckpt = scratch_path(spark, "rows"), scratch_path(spark, "scores"), scratch_path(spark, "ckpt")
    for new in (rows.filter((F.col("ts") >= first) & (F.col("ts") < second)), rows.filter(F.col("ts") >= second), None):
        if new is not None:
            tb.write_table(new, source, "append")
        scoring.score_stream(fl.stream_table(spark, source, rows.schema), lambda batch: scorer(batch, store.load()), out, ckpt)
    return spark.read.parquet(out).drop("batch_id")


def given_layers(rows, tails):
    """Three layers that SQL can compute as well: two tail scores and the session z."""
    scores = tail_scores(rows, sg.MODEL_FEATURES, model=tails).select("login_id", F.round(-F.col("copod"), 6).alias("iforest"), F.round("ecod", 6).alias("ecod"))
    return scores.join(rows.select("login_id", "ts", (-F.col("session_duration_zscore")).alias("per_user")), "login_id")


def given_parts(train):
    tails = cut_lineage(fit_tails(train, sg.MODEL_FEATURES))
    return {"tails": tails, "bounds": fit_composite(cut_lineage(given_layers(train, tails)))}


_COLS = ", ".join(MATRIX_COLUMNS)
_FITTED = ", ".join(f"min({x}) FILTER (train) AS {x}0, max({x}) FILTER (train) AS {x}1" for x in "abc")
_SIGNALS = ", ".join(f"CASE WHEN {x}1 > {x}0 THEN ({x} - {x}0) / ({x}1 - {x}0) ELSE 0 END AS {x}" for x in "abc")
STORED = f"""WITH {MATRIX},
m2 AS MATERIALIZED (SELECT mat.login_id, feat.ts, feat.ts < TIMESTAMP '{SPLITS[0]}' AS train, {", ".join("mat." + c for c in MATRIX_COLUMNS)} FROM mat JOIN feat ON feat.login_id = mat.login_id),
alll AS MATERIALIZED (UNPIVOT (SELECT login_id, train, {_COLS} FROM m2) ON {_COLS} INTO NAME feature VALUE value),
cnt AS (SELECT feature, value, count(*) AS n FROM alll WHERE train GROUP BY ALL),
cum AS MATERIALIZED (SELECT *, sum(n) OVER (PARTITION BY feature ORDER BY value) AS upto FROM cnt),
facts AS MATERIALIZED (SELECT feature, count(*) AS total, sign(coalesce(skewness(value), 0)) AS s FROM alll WHERE train GROUP BY feature),
val AS (SELECT DISTINCT feature, value FROM alll),
pos AS (SELECT v.feature, v.value, coalesce(c.upto, 0) AS upto, CASE WHEN c.value = v.value THEN c.upto - c.n ELSE coalesce(c.upto, 0) END AS below
  FROM val v ASOF LEFT JOIN cum c ON v.feature = c.feature AND v.value >= c.value),
lr AS (SELECT feature, value, s, -ln(CAST(greatest(upto, 1) AS DOUBLE) / total) AS l, -ln(CAST(greatest(total - below, 1) AS DOUBLE) / total) AS r
  FROM pos JOIN facts USING (feature)),
contrib AS MATERIALIZED (SELECT *, CASE WHEN s < 0 THEN l WHEN s > 0 THEN r ELSE l + r END AS k FROM lr),
tails AS (SELECT login_id, round(sum(greatest(k, (l + r) / 2)), 6) AS a, round(sum(greatest(l, r, k)), 6) AS b FROM alll JOIN contrib USING (feature, value) GROUP BY login_id),
lay AS MATERIALIZED (SELECT login_id, ts, train, a, b, session_duration_zscore AS c FROM tails JOIN m2 USING (login_id)),
edge AS (SELECT {_FITTED} FROM lay),
sig AS (SELECT login_id, ts, train, {_SIGNALS} FROM lay, edge),
raws AS MATERIALIZED (SELECT *, CAST(0.35 AS DOUBLE) * a + CAST(0.3 AS DOUBLE) * b + CAST(0.35 AS DOUBLE) * c AS raw FROM sig),
risk AS (SELECT login_id, ts, train, round(greatest(0, least(1, (raw - (SELECT min(raw) FROM raws WHERE train)) / ((SELECT max(raw) FROM raws WHERE train)
  - (SELECT min(raw) FROM raws WHERE train)))), 6) AS risk_score FROM raws)"""


@query("st_score_new", STORED + f""" SELECT login_id, ts, {r6('risk_score')}, CASE WHEN risk_score >= 0.8 THEN 'Critical' WHEN risk_score >= 0.6 THEN 'High'
  WHEN risk_score >= 0.3 THEN 'Medium' ELSE 'Low' END AS risk_tier, CAST(risk_score >= 0.6 AS BIGINT) AS is_anomaly FROM risk WHERE NOT train""")
def _(spark, d):
    """Composite of new sign-ins on given layers, from stored tails and bounds."""
    out = scored_in_increments(spark, d, given_parts, lambda rows, model: composite_risk(given_layers(rows, model["tails"]), model["bounds"]))
    return out.select("login_id", "ts", "risk_score", "risk_tier", "is_anomaly")


@query("st_score_composite")
def _(spark, d):
    """Composite of new sign-ins from the stored forest, tails, user models and bounds, with the two strongest features of flagged rows."""
    return scored_in_increments(spark, d, scoring.fit, scoring.score)
