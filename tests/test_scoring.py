import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tarn.operators.tails import fit_tails, tail_scores
from tarn.plans import scoring
from tarn.sources import files as fl
from tarn.sources import tables as tb

COLUMNS = ["a", "b"]
SCHEMA = "login_id long, user_id long, ts timestamp, a double, b double"


def rows(spark, n, first=0, users=4, seed=1):
    r = random.Random(seed + first)
    t = dt.datetime(2024, 1, 1)
    data = [(first + i, (first + i) % users, t + dt.timedelta(hours=first + i), round(r.gauss(0, 1), 1), r.choice([0.0, 0.0, 1.0]) + (30.0 if i == 7 else 0)) for i in range(n)]
    return spark.createDataFrame(data, SCHEMA)


def small_model(train):
    return scoring.fit(train, COLUMNS, n_trees=20, user_trees=10)


def small_score(new, model):
    return scoring.score(new, model, COLUMNS, user_trees=10)


def as_dict(df):
    return {r["login_id"]: r.asDict() for r in df.drop("batch_id").collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-9, nan_ok=True) if not any(isinstance(v, (str, dt.datetime)) for v in a[k].values()) else all(
            (x == pytest.approx(b[k][c], abs=1e-9)) if isinstance(x, float) else x == b[k][c] for c, x in a[k].items())


def test_store_increments_and_replay_equal_one_run(spark, tmp_path):
    store = scoring.ModelStore(spark, str(tmp_path / "models"))
    with pytest.raises(LookupError):
        store.load()
    train = rows(spark, 160)
    assert store.save(small_model(train), train) == 1
    new = rows(spark, 60, 1000, users=6).unionByName(rows(spark, 5, 2000, users=1, seed=3).withColumn("user_id", F.lit(99).cast("long")))
    whole = as_dict(small_score(new, store.load()))
    assert len(whole) == 65 and all(0 <= r["risk_score"] <= 1 for r in whole.values())
    assert whole[1007]["is_anomaly"] == 1 and whole[1007]["top1_feature"] == "b" and whole[2000]["per_user"] == 0.0

    source, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    scorer = lambda batch: small_score(batch, store.load())
    for part in ("login_id < 1020", "login_id >= 1020"):
        tb.write_table(new.filter(part), source, "append")
        scoring.score_stream(fl.stream_table(spark, source, new.schema), scorer, out, ck)
    same(as_dict(spark.read.parquet(out)), whole)
    assert spark.read.parquet(out).count() == 65
    # the second batch runs again, as after a failure before its commit was noted
    (tmp_path / "ck" / "commits" / "1").unlink()
    (tmp_path / "ck" / "commits" / ".1.crc").unlink(missing_ok=True)
    scoring.score_stream(fl.stream_table(spark, source, new.schema), scorer, out, ck)
    assert spark.read.parquet(out).count() == 65
    same(as_dict(spark.read.parquet(out)), whole)


def test_versions(spark, tmp_path):
    store = scoring.ModelStore(spark, str(tmp_path / "m"))
    for i in (1, 2):
        assert store.save({"x": spark.range(i)}) == i
    assert store.load()["x"].count() == 2 and store.load(1)["x"].count() == 1
    tb.write_table(spark.range(9), str(tmp_path / "m" / "half-written" / "x"))  # a version that was never listed
    assert store.load()["x"].count() == 2
    with pytest.raises(LookupError):
        store.load(7)


def test_tails_of_new_values(spark):
    import numpy as np

    train, new = rows(spark, 300, seed=5), rows(spark, 40, 500, seed=6).unionByName(spark.createDataFrame([(1, 1, None, -99.0, 99.0)], SCHEMA))
    got = {r["login_id"]: r["ecod"] for r in tail_scores(new, COLUMNS, model=fit_tails(train, COLUMNS)).collect()}
    x = train.select(*COLUMNS).toPandas()
    want = {}
    for r in new.collect():
        total = 0.0
        for c in COLUMNS:
            v, n = x[c].to_numpy(), len(x)
            left, right = -np.log(max((v <= r[c]).sum(), 1) / n), -np.log(max((v >= r[c]).sum(), 1) / n)
            skew = ((v - v.mean()) ** 3).mean()
            total += max(left, right, left if skew < 0 else right)
        want[r["login_id"]] = total
    assert got == pytest.approx(want)
    alone = {r["login_id"]: r["ecod"] for r in tail_scores(new.filter("login_id = 510"), COLUMNS, model=fit_tails(train, COLUMNS)).collect()}
    assert alone[510] == pytest.approx(want[510])
