"""Chunked sequence operators against straightforward computation."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarn.operators import sequences as seq
from tarn.operators.quantiles import exact_quantiles, flag_quantile, flag_quantiles, ranked, value_counts
from tarn.operators.tails import join_by_value


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        user = rnd.choice([1, 1, 1, 2, 3, None])
        rows.append((i, user, start + dt.timedelta(seconds=rnd.randrange(0, 40_000) // 7 * 7), float(i)))
    return spark.createDataFrame(rows, "login_id long, user_id long, ts timestamp, v double").cache()


def test_previous_equals_lag(events):
    w = Window.partitionBy("user_id").orderBy("ts", "login_id")
    want = events.select("login_id", F.lag("v").over(w).alias("prev_v"), F.lag("ts").over(w).alias("prev_ts"))
    got = seq.with_previous(events, ["v", "ts"]).select("login_id", "prev_v", "prev_ts")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_recent_equals_range_frame(events):
    timed = events.withColumn("e", F.unix_timestamp("ts"))
    w = Window.partitionBy("user_id").orderBy("e").rangeBetween(-3600, 0)
    want = {r["login_id"]: r["n"] for r in timed.select("login_id", F.count(F.lit(1)).over(w).alias("n")).collect()}
    got = {r["login_id"]: r["logins_last_hour"] for r in seq.count_recent(events).collect()}
    assert got == want


def test_one_user_with_all_events_in_one_hour(spark):
    rows = spark.range(3000).selectExpr("id as login_id", "7L as user_id", "timestamp_seconds(1704067200 + (id * 37) % 1700) as ts", "cast(id as double) as v").cache()
    w = Window.partitionBy("user_id").orderBy("ts", "login_id")
    want = rows.select("login_id", F.lag("v").over(w).alias("prev_v")).collect()
    assert sorted(map(str, seq.with_previous(rows, ["v"]).select("login_id", "prev_v").collect())) == sorted(map(str, want))
    frame = Window.partitionBy("user_id").orderBy(F.unix_timestamp("ts")).rangeBetween(-3600, 0)
    want = rows.select("login_id", F.count(F.lit(1)).over(frame).alias("n")).collect()
    assert sorted((r["login_id"], r["logins_last_hour"]) for r in seq.count_recent(rows).collect()) == sorted((r["login_id"], r["n"]) for r in want)


def test_rolling_z_equals_pandas(spark):
    rng = np.random.default_rng(1)
    y = np.r_[rng.normal(size=70), np.zeros(40), rng.normal(size=33)]
    pdf = pd.DataFrame({"bucket_ts": pd.date_range("2024-01-01", periods=len(y), freq="5min"), "y": y})
    r = pdf["y"].rolling(24, min_periods=8)
    std = r.std().where(lambda s: s > 1e-7)
    want = ((pdf["y"] - r.mean()) / std).fillna(0.0).to_numpy()
    got = seq.rolling_z(spark.createDataFrame(pdf), {"y": "z"}, rows=24, min_rows=8).orderBy("bucket_ts").toPandas()["z"].to_numpy()
    assert np.allclose(got, want, atol=1e-6)


def test_dedup_keeps_first_and_groups_null(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), ("x", "c"), ("x", "b")], "k string, name string")
    assert {tuple(r) for r in seq.dedup(df, ["k"], ["name"]).collect()} == {("x", "b"), (None, "a")}


def test_quantiles_with_hot_values(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": np.repeat(["a", "b", "c"], [4000, 700, 1]),
                        "v": np.r_[np.zeros(2500), rng.exponential(size=1500), rng.normal(size=700), [3.0]]})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.1, 0.5, 0.625, 0.95, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, "v", probs, ["g"], bins=16).collect()}
    for g, part in pdf.groupby("g"):
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.quantile(part["v"], p), abs=1e-12)
    one = exact_quantiles(df, "v", [0.9]).collect()[0]["quantile"]
    assert one == pytest.approx(np.quantile(pdf["v"], 0.9), abs=1e-12)
    assert flag_quantile(df, "v", 0.9).agg(F.sum("is_flagged")).first()[0] == int((pdf["v"] > one).sum())


def test_many_small_groups_bring_no_table_of_edges(spark, monkeypatch):
    from tarn.operators import joins
    from tarn.operators.quantiles import _binned

    seen = []
    kept = joins.lookup
    monkeypatch.setattr(joins, "lookup", lambda facts, reference, *a, **b: seen.append(reference.count()) or kept(facts, reference, *a, **b))
    df = spark.createDataFrame([(i % 300, float(i)) for i in range(3000)] + [(999, float(i)) for i in range(2000)], "g long, v double")
    got = {r["g"]: r["quantile"] for r in exact_quantiles(df, "v", [0.25], ["g"], bins=16).collect()}
    assert got[999] == np.quantile(np.arange(2000.0), 0.25) and got[7] == np.quantile(np.arange(7.0, 3000, 300), 0.25) and len(got) == 301
    assert seen == [1]  # edges of the large group alone
    sizes = _binned(value_counts(df, "v", ["g"]), ["g"], 16).filter("g = 999").groupBy("_bin").count().toPandas()["count"]
    assert len(sizes) == 16 and sizes.max() < 200


def test_flags_of_several_columns(spark):
    df = spark.createDataFrame([(float(i), float(-i)) for i in range(101)], "a double, b double")
    got = flag_quantiles(df, {"a": "fa", "b": "fb"}, 0.95).agg(F.sum("fa"), F.sum("fb"), F.sum(F.col("fa") * F.col("fb"))).first()
    assert tuple(got) == (5, 5, 0)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert exact_quantiles(empty, "v", [0.5]).collect() == []


def test_ranks_and_value_join(spark):
    df = spark.createDataFrame([(i, "f", float(min(i, 3))) for i in range(3000)], "id long, feature string, value double")
    ranks = ranked(value_counts(df, "value", ["feature"]), ["feature"])
    assert {(r["value"], r["below"], r["upto"]) for r in ranks.collect()} == {(0.0, 0, 1), (1.0, 1, 2), (2.0, 2, 3), (3.0, 3, 3000)}
    joined = join_by_value(df, ranks.select("feature", "value", "n", "total", "upto"), ["feature", "value"])
    assert joined.count() == 3000 and joined.filter("upto IS NULL").count() == 0


def test_a_far_value_does_not_crowd_the_others(spark):
    from tarn.operators.quantiles import _binned, exact_quantiles, value_counts

    values = [float(i) / 50 for i in range(5000)] + [1e12, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    sizes = [r["count"] for r in _binned(value_counts(df, "v"), [], 512).groupBy("_bin").count().collect()]
    assert max(sizes) < 60
    assert exact_quantiles(df, "v", [0.5]).first()["quantile"] == sorted(values)[2500] * 0.5 + sorted(values)[2501] * 0.5


def test_row_index_numbers_each_series(spark):
    rng = np.random.default_rng(11)
    t0 = pd.Timestamp("2024-01-01")
    rows = [(s, t0 + pd.Timedelta(minutes=int(m))) for s in ("a", "b", None) for m in np.sort(rng.choice(20_000, 300, replace=False))]
    df = spark.createDataFrame([(s, t.to_pydatetime()) for s, t in rows], "s string, bucket_ts timestamp")
    got = seq.with_row_index(df, "bucket_ts", ["s"]).toPandas()
    assert len(got) == 900
    for _, part in got.groupby("s", dropna=False):
        assert part.sort_values("bucket_ts")["_i"].tolist() == list(range(300))
    whole = seq.with_row_index(df.select(F.unix_timestamp("bucket_ts").alias("at")).distinct(), "at", chunk=5000).toPandas()
    assert whole.sort_values("at")["_i"].tolist() == list(range(len(whole)))


def test_rolling_z_of_series_with_and_without_a_name(spark):
    rng = np.random.default_rng(12)
    parts = []
    for s in ("a", None):
        y = rng.normal(size=900)
        r = pd.Series(y).rolling(50, min_periods=8)
        parts.append(pd.DataFrame({"s": s, "bucket_ts": pd.date_range("2024-01-01", periods=900, freq="30min"), "y": y,
                                   "want": ((y - r.mean()) / r.std()).fillna(0.0)}))
    df = spark.createDataFrame(pd.concat(parts).replace({np.nan: None}))
    got = seq.rolling_z(df, {"y": "z"}, rows=50, min_rows=8, partition=["s"]).toPandas()
    assert len(got) == 1800 and np.allclose(got["z"], got["want"], atol=1e-6)
    one = seq.rolling_z(df.filter("s = 'a'"), {"y": "z"}, rows=1, min_rows=1).toPandas()
    assert (one["z"] == 0).all()


def test_long_series_in_pieces_is_close_to_the_whole(spark):
    from tarn.operators.seasonal import residual, stl_residual

    rng = np.random.default_rng(13)
    period, n = 24, 24 * 60 + 7
    t = np.arange(n)
    y = 10 + 3 * np.sin(2 * np.pi * t / period) + t / 400 + rng.normal(scale=0.3, size=n)
    y[[200, 700, 1200]] += 6
    pdf = pd.DataFrame({"s": "a", "bucket_ts": pd.date_range("2024-01-01", periods=n, freq="h"), "y": y})
    short = pdf.head(24 * 30).assign(s=None)
    df = spark.createDataFrame(pd.concat([pdf, short]).replace({np.nan: None}), "s string, bucket_ts timestamp, y double")
    got = stl_residual(df, ["y"], period, "s", piece=16, halo=14).toPandas().sort_values("bucket_ts")
    whole = residual(y, period)
    off = np.abs(got[got["s"] == "a"]["y_resid"].to_numpy() - whole)
    print("largest difference", off.max(), "mean", off.mean(), "spread", whole.std())
    assert off.max() < 0.01 * whole.std()
    alone = got[got["s"].isna()]["y_resid"].to_numpy()
    assert len(got) == n + 24 * 30 and np.allclose(alone, residual(y[:24 * 30], period))
