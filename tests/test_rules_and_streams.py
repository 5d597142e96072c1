"""Edges of rules and tiers, monitoring, streams and increments."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarn.functions.geo import geo_velocity, haversine
from tarn.functions.texts import clean_text, contains_any, file_extension
from tarn.functions.times import is_off_hours, is_weekend
from tarn.functions.values import clip, tier, tier_right, tier_z
from tarn.operators.aggregates import bucket_metrics, histogram
from tarn.operators.evaluation import best_threshold, threshold_sweep
from tarn.operators.joins import lookup
from tarn.operators.scaling import minmax
from tarn.plans import messages as msg
from tarn.plans import monitoring as mon
from tarn.sources import files as fl
from tarn.sources import tables as tb
from tarn.streaming import increments, ingest, windows


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_tier_edges(spark):
    r = one(spark, tier(F.lit(0.3)), tier(F.lit(0.8)), tier(F.lit(0.2999)), tier_right(F.lit(0.3)), tier_right(F.lit(0.8)),
            tier_z(F.lit(3.0)), tier_z(F.lit(8.0)), tier_z(F.lit(2.99)))
    assert list(r) == ["Medium", "Critical", "Low", "Low", "High", "medium", "critical", "low"]


def test_hours_and_days(spark):
    ts = [dt.datetime(2024, 1, 5, h) for h in (6, 7, 19, 20)] + [dt.datetime(2024, 1, 6, 12), dt.datetime(2024, 1, 7, 12)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp")
    rows = df.orderBy("ts").select(is_off_hours("ts").alias("o"), is_weekend("ts").alias("w")).collect()
    assert [r["o"] for r in rows] == [True, False, False, True, False, False]
    assert [r["w"] for r in rows] == [False] * 4 + [True, True]


def test_geo_null_and_identical(spark):
    none = F.lit(None).cast("double")
    r = one(spark, haversine(none, none, F.lit(1.0), F.lit(1.0)), haversine(none, none, F.lit(1.0), F.lit(1.0), 0.0),
            haversine(F.lit(5.0), F.lit(5.0), F.lit(5.0), F.lit(5.0)), geo_velocity(F.lit(10.0), F.lit(0.0)),
            haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)))
    assert r[0] is None and r[1] == 0 and r[2] == 0 and r[3] is None and r[4] == pytest.approx(20015.0868, abs=1e-3)


def test_text(spark):
    r = one(spark, clean_text(F.lit("See http://a.b/c or x.y@z.org NOW!")), clean_text(F.lit(None).cast("string")),
            clean_text(F.lit("https://only.example")), contains_any(F.lit(None).cast("string"), ["a"]),
            contains_any(F.lit("Zip Up all"), ["zip up"]), file_extension(F.lit("noext")), file_extension(F.lit("a.tar.gz")),
            clip(F.lit(None).cast("double"), hi=1.0))
    assert list(r) == ["see or now", "", "", False, True, "", "gz", None]


def test_constant_column_and_histogram_edges(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert {r["v"] for r in minmax(df, ["v"]).collect()} == {0.0}
    h = spark.createDataFrame([(0.0,), (1.0,), (-5.0,), (None,)], "v double")
    assert {(r["bin"], r["n_rows"]) for r in histogram(h, "v", 0, 1, 10).collect()} == {(0, 2), (9, 1)}


def test_lookup_spreads_only_hot_keys(spark):
    data = [(i, 0 if i % 2 else i) for i in range(400)] + [(1000 + i, None) for i in range(30)]
    facts = spark.createDataFrame(data, "id long, k long")
    ref = spark.createDataFrame([(k, f"n{k}") for k in range(0, 300, 2)], "k long, name string")
    want = sorted((i, f"n{k}" if k is not None and k < 300 else None) for i, k in data)
    for args in ({}, {"max_rows": 1}, {"max_rows": 1, "hot_rows": 20}, {"max_rows": 1, "hot_rows": 20, "lanes": 3}):
        got = lookup(facts, ref, ["k"], **args)
        assert sorted(map(tuple, got.select("id", "name").collect())) == want
    inner = lookup(facts, ref, ["k"], "inner", max_rows=1, hot_rows=20)
    assert inner.count() == sum(n is not None for _, n in want)
    repeated = spark.createDataFrame([(0, "a"), (2, "b")], "k long, name string")
    plan = lookup(facts, repeated, ["k"], max_rows=1, hot_rows=20, lanes=5)
    assert plan.filter("k = 0").count() == 201 and "_lane" not in plan.columns


def test_sweep_edges(spark):
    df = spark.createDataFrame([(0.0, 0), (0.15, 1), (0.6, 0), (1.0, 1)], "s double, y int")
    sweep = threshold_sweep(df, "s", "y", 2)
    rows = {round(r["threshold"], 2): r for r in sweep.collect()}
    assert len(rows) == 21 and rows[0.15]["true_positives"] == 2 and rows[0.2]["true_positives"] == 1
    assert rows[1.0]["precision"] == 1.0 and rows[0.0]["alerts_per_day"] == 2.0
    best = {r["criterion"]: r["threshold"] for r in best_threshold(sweep, 1.0).collect()}
    assert best["max_f1"] == pytest.approx(0.05) and best["capacity"] == pytest.approx(0.2)


def test_injected_fault_is_flagged(spark):
    empty = tb.inline(spark, [], mon.HEALTH_SCHEMA)
    now = F.lit("2024-02-01").cast("timestamp")
    bad = mon.pipeline_anomalies(mon.with_injected_fault(empty), mon.Thresholds(), now, stale=False).collect()
    assert len(bad) == 1 and bad[0]["anomaly_reasons"] == "low_volume:12; high_null_rate:0.42"


def test_one_message_scores_as_in_its_batch(spark):
    rows = spark.createDataFrame([(i, i % 6, 0.1 * i, 0.2 * i) for i in range(8)],
                                 "email_id long, dominant_topic int, topic_confidence double, lda_entropy double")
    bounds = msg.fit_batch_bounds(rows)
    whole = {r["email_id"]: r["risk_score"] for r in msg.nlp_batch_score(rows, bounds).collect()}
    alone = msg.nlp_batch_score(rows.filter("email_id = 5"), bounds).first()["risk_score"]
    assert alone == pytest.approx(whole[5])


def test_stream_resumes_and_keeps_unknown_records(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    tb.land_jsonl(spark.range(1200).select("id"), src, 500)
    ingest.ingest_stream(spark, src, "id long", out, ck)
    ingest.ingest_stream(spark, src, "id long", out, ck)
    assert spark.read.parquet(out).count() == 1200
    tb.land_jsonl(spark.range(1200, 1210).select("id"), src, 500)
    ingest.ingest_stream(spark, src, "id long", out, ck)
    got = spark.read.parquet(out)
    assert got.count() == 1210 and got.filter("_source_file IS NULL OR _ingested_at IS NULL").count() == 0
    schema = fl.infer_json_schema(spark, src, str(tmp_path / "schema"))
    assert fl.CORRUPT in schema.names and fl.infer_json_schema(spark, str(tmp_path / "gone"), str(tmp_path / "schema")) == schema


def test_late_events_are_dropped_and_closed_windows_equal_batch(spark, tmp_path):
    base = dt.datetime(2024, 1, 1, 8)
    names = "login_id long, user_id long, ts timestamp, ip_address string, failed_attempts_before long, mfa_used boolean, success boolean"

    def rows(minutes, start):
        return spark.createDataFrame([(start + i, i % 3, base + dt.timedelta(minutes=m), f"10.0.0.{i % 4}", i % 2, True, True)
                                      for i, m in enumerate(minutes)], names)

    src, out, ck = str(tmp_path / "s"), str(tmp_path / "o"), str(tmp_path / "c")
    on_time = rows([0, 1, 2, 6, 7, 12, 40], 0)
    tb.write_table(on_time, src)
    ingest.stream_to(windows.bucket_metrics_stream(fl.stream_table(spark, src, on_time.schema)), out, ck)
    tb.write_table(rows([3, 60], 100), src, "append")       # 3 is long past the watermark
    ingest.stream_to(windows.bucket_metrics_stream(fl.stream_table(spark, src, on_time.schema)), out, ck)
    got = {r["bucket_ts"]: r for r in spark.read.parquet(out).collect()}
    want = {r["bucket_ts"]: r for r in bucket_metrics(on_time).collect()}
    assert set(got) == set(want)
    for k, r in want.items():
        assert all(got[k][c] == pytest.approx(r[c]) for c in r.asDict() if c != "bucket_ts")


def test_increments_equal_one_run(spark, tmp_path):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1, i)) for i in range(10)], "id long, ts timestamp")
    score = lambda d: d.withColumn("s", F.col("id") * 2)
    path = str(tmp_path / "scores")
    assert increments.score_increment(df.filter("id < 4"), path, score)
    assert increments.score_increment(df, path, score)
    assert not increments.score_increment(df, path, score)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, score(df).collect()))


def test_typed_empty_table_and_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tb.ensure_table(spark, path, "a int, b string").count() == 0
    tb.write_table(spark.createDataFrame([(1, "x")], "a int, b string"), path, "append")
    assert tb.ensure_table(spark, path, "a int, b string").count() == 1
    with pytest.raises(Exception, match="row count of t"):
        tb.check_counts({"t": spark.read.parquet(path)}, {"t": 2}).collect()


def test_fields_outside_the_remembered_schema_are_kept(spark, tmp_path):
    from tarn.sources.files import json_stream_inferred
    from tarn.streaming.ingest import stream_to

    source, schema, out, ckpt = (str(tmp_path / x) for x in ("in", "schema", "out", "ckpt"))
    spark.createDataFrame([('{"id":1,"v":"x"}',)], "value string").write.text(source)
    stream_to(json_stream_inferred(spark, source, schema), out, ckpt)
    line = '{"id":2,"v":"y","extra":"z"}'
    spark.createDataFrame([(line,), ('{"id":3,"v":"w"}',), ("not json",)], "value string").write.mode("append").text(source)
    stream_to(json_stream_inferred(spark, source, schema), out, ckpt)
    got = {r["id"]: r["_raw_record"] for r in spark.read.parquet(out).collect()}
    assert got == {1: None, 2: line, 3: None, None: "not json"}


def test_stream_counts_events_of_one_second_for_each_other(spark, tmp_path):
    import datetime as dt

    from tarn.streaming.ingest import stream_to
    from tarn.streaming.user_state import SETTINGS, user_features_stream

    t = dt.datetime(2024, 1, 1, 10)
    rows = [(1, 7, t, 1.0, 2.0, "a"), (2, 7, t, 1.0, 2.0, "b"), (3, 7, t + dt.timedelta(minutes=30), 2.0, 2.0, "a"), (4, 7, t + dt.timedelta(hours=2), 2.0, 2.0, "c")]
    schema = "login_id long, user_id long, ts timestamp, latitude double, longitude double, device string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = user_features_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "2024-01-01 11:00:00")
    stream_to(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), **SETTINGS)
    got = {r["login_id"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert [got[i]["logins_last_hour"] for i in (1, 2, 3, 4)] == [2, 2, 3, 1]
    assert [got[i]["is_new_device"] for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert got[1]["minutes_since_last_login"] is None and got[2]["geo_velocity_kmh"] is None and got[3]["minutes_since_last_login"] == 30.0


def test_a_user_who_returns_after_the_idle_time_is_known(spark, tmp_path):
    from tarn.streaming.ingest import stream_to
    from tarn.streaming.user_state import SETTINGS, user_features_stream

    t = dt.datetime(2024, 1, 1, 10)
    schema = "login_id long, user_id long, ts timestamp, latitude double, longitude double, device string"
    for login, user, day in [(1, 7, 0), (2, 8, 40), (3, 8, 41), (4, 7, 42)]:
        spark.createDataFrame([(login, user, t + dt.timedelta(days=day), 1.0, 2.0, "a")], schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = user_features_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "2024-01-02 00:00:00")
        stream_to(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), **SETTINGS)
    got = {r["login_id"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[4]["is_new_device"] == 0 and got[4]["minutes_since_last_login"] == 42 * 1440.0 and got[4]["distance_from_prev_km"] == 0.0


SEEN = "login_id long, user_id long, ts timestamp, latitude double, longitude double, device string"


def _user_batches(spark, folder, batches, **options):
    """Run the stream once per batch of rows."""
    from tarn.streaming.ingest import stream_to
    from tarn.streaming.user_state import SETTINGS, user_features_stream

    for rows in batches:
        spark.createDataFrame(rows, SEEN).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = user_features_stream(spark.readStream.schema(SEEN).parquet(f"{folder}/in"), "2024-01-02 00:00:00", **options)
        stream_to(stream, f"{folder}/out", f"{folder}/ckpt", **SETTINGS)
    return {r["login_id"]: r for r in spark.read.parquet(f"{folder}/out").collect()}


def test_late_events_are_kept_and_compared_with_the_event_before(spark, tmp_path):
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    got = _user_batches(spark, tmp_path, [
        [(1, 7, t(10), 0.0, 0.0, "a"), (5, 8, t(9), 0.0, 0.0, "x")], [(2, 7, t(14), 0.0, 3.0, "b")],
        [(3, 7, t(11, 30), 0.0, 1.0, "b"), (4, 7, t(11, 0), 0.0, 1.0, "a")], [(6, 7, t(14, 30), None, 3.0, None), (7, 7, t(15), 0.0, 3.0, "c")]])
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7]
    assert [got[i]["is_late"] for i in range(1, 8)] == [0, 0, 1, 1, 0, 0, 0]
    assert [got[i]["minutes_since_last_login"] for i in range(1, 8)] == [None, 240.0, 30.0, 60.0, None, 30.0, 30.0]
    assert [got[i]["logins_last_hour"] for i in range(1, 8)] == [1, 1, 2, 2, 1, 2, 3]
    assert got[4]["geo_velocity_kmh"] == pytest.approx(111.19, abs=0.05) and got[3]["distance_from_prev_km"] == 0.0
    assert got[6]["distance_from_prev_km"] is None and got[7]["distance_from_prev_km"] is None


def test_expired_hours_leave_the_newest_event_and_devices(spark, tmp_path):
    import time

    t = dt.datetime(2024, 1, 1, 10)
    first = [(1, 7, t, 0.0, 0.0, "a"), (2, 7, t + dt.timedelta(minutes=10), 0.0, 1.0, "b")]
    got = _user_batches(spark, tmp_path / "x", [first], idle_days=0.2 / 86_400)
    time.sleep(0.5)
    got = _user_batches(spark, tmp_path / "x", [[(3, 7, t + dt.timedelta(minutes=40), 0.0, 2.0, "a"), (4, 7, t + dt.timedelta(days=2), 0.0, 2.0, "z")]], idle_days=0.2 / 86_400)
    assert got[3]["minutes_since_last_login"] == 30.0 and got[3]["logins_last_hour"] == 1  # the hours are gone, the newest event is not
    assert [got[i]["is_new_device"] for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    kept = _user_batches(spark, tmp_path / "y", [first, [(3, 7, t + dt.timedelta(minutes=40), 0.0, 2.0, "a")]], idle_days=None)
    assert kept[3]["logins_last_hour"] == 3


def test_many_batches_equal_one(spark, tmp_path):
    import random

    r = random.Random(3)
    t, rows = dt.datetime(2024, 1, 1), []
    for i in range(200):
        t += dt.timedelta(minutes=r.choice([0, 1, 5, 30, 300]))
        rows.append((i, r.randrange(4), t, r.uniform(-5, 5), r.uniform(-5, 5), r.choice("abcdefgh")))
    cut = [0, 60, 61, 130, 200]
    cut = [next(j for j in range(c, 201) if j in (0, 200) or rows[j][2] > rows[j - 1][2]) for c in cut]
    parts = _user_batches(spark, tmp_path / "p", [rows[a:b] for a, b in zip(cut, cut[1:])], recent_hours=2)
    whole = _user_batches(spark, tmp_path / "w", [rows])
    for i in range(200):
        for c in ("minutes_since_last_login", "distance_from_prev_km", "geo_velocity_kmh", "logins_last_hour"):
            assert parts[i][c] == (pytest.approx(whole[i][c]) if whole[i][c] is not None else None), (i, c)
