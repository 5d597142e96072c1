"""Forests per user: one pass for scores and attributions gives what separate passes give, whatever the ids."""

import numpy as np
import pandas as pd
import pytest

from tarn.operators import forest as fo
from tarn.operators import trees as tr

COLS = ["a", "b", "c"]


def table(spark, n=260):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(n, 3)), 2)
    x[::40] += 7
    x[:, 2] = x[:, 2] > 0
    user = np.repeat([1, 2, 3, 4], [n - 110, 60, 40, 10])
    pdf = pd.DataFrame(x, columns=COLS).assign(login_id=np.arange(n), user_id=user)
    return spark.createDataFrame(pdf, "a double, b double, c double, login_id long, user_id long")


def rows(df):
    pdf = df.toPandas()
    return pdf.sort_values(list(pdf.columns)).reset_index(drop=True)


@pytest.mark.parametrize("kind", ["plain", "repeated", "no id", "no user", "chunks"])
def test_one_pass_equals_scores_and_then_explanations(spark, monkeypatch, kind):
    df = table(spark)
    if kind == "repeated":  # an id twice for one user and an id of two users
        df = df.unionByName(df.filter("login_id = 170")).unionByName(df.filter("login_id = 200").selectExpr("a", "b", "c", "login_id", "3L AS user_id"))
    if kind == "no id":
        df = df.selectExpr("a", "b", "c", "nullif(login_id, 170) AS login_id", "user_id")
    if kind == "no user":
        df = df.selectExpr("a", "b", "c", "login_id", "nullif(user_id, 3) AS user_id")
    if kind == "chunks":
        monkeypatch.setattr(fo, "CHUNK_ROWS", 50)
    got = fo.per_user_explain(df, None, COLS, 2, n_trees=15)
    scores = fo._scores_by_id(df, COLS, "login_id", "user_id", 15, 256, 42)
    pd.testing.assert_frame_equal(rows(fo.per_user_scores(df, COLS, n_trees=15)), rows(scores), check_dtype=False)
    want = rows(fo.per_user_explain(df, scores, COLS, 2, n_trees=15))
    pd.testing.assert_frame_equal(rows(got), want, check_dtype=False)
    assert want["top1_feature"].notna().sum() == (want["per_user_anomaly"] == 1).sum() > 0


def test_string_users_keep_their_forest(spark):
    df = table(spark).selectExpr("a", "b", "c", "login_id", "concat('u', user_id) AS user_id")
    pd.testing.assert_frame_equal(rows(fo.per_user_scores(df, COLS, n_trees=15)), rows(fo._scores_by_id(df, COLS, "login_id", "user_id", 15, 256, 42)), check_dtype=False)


def plain_tree(x, rng, limit):
    """(rows of each node by level, feature, cut) of one tree, node after node."""
    level, out = [np.arange(len(x))], []
    for _ in range(limit):
        wish, place, nxt = rng.random((len(level), x.shape[1])), rng.random(len(level)), []
        for i, at in enumerate(level):
            lo, hi = x[at].min(axis=0), x[at].max(axis=0)
            if not (hi > lo).any():
                continue
            f = int(np.where(hi > lo, wish[i], -1).argmax())
            cut = min(lo[f] + place[i] * (hi[f] - lo[f]), np.nextafter(hi[f], -np.inf))
            out.append((len(at), f, cut))
            nxt += [at[x[at, f] <= cut], at[x[at, f] > cut]]
        if not nxt:
            break
        level = nxt
    return out


@pytest.mark.parametrize("n", [40, 400])
def test_trees_split_as_node_after_node(n):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(n, 4)), 1)
    x[:, 1] = x[:, 1] > 0
    x[:, 2] = 3.0
    x[: n // 3] = x[0]  # copies
    forest = tr.grow(x, [np.arange(n)], n, np.random.default_rng(1))
    inner = np.flatnonzero(forest.feature >= 0)
    got = [(int(forest.size[i]), int(forest.feature[i]), float(forest.threshold[i])) for i in inner]
    assert got == plain_tree(x, np.random.default_rng(1), int(np.ceil(np.log2(n))))


def test_attributions_over_nodes_equal_those_over_leaves():
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(120, 3)), 1)  # three columns, so each occurs more than once on a path
    forest = tr.grow(x, [rng.permutation(120)[:90] for _ in range(25)], 90, rng)
    got = tr.forest_attributions(forest, x[:30], 3)
    assert np.allclose(got, tr.attributions(tr.leaf_paths(forest), x[:30], 3), atol=1e-12)
    odd = x[:5].copy()
    odd[0, 0], odd[1, 1] = np.nan, np.inf
    assert np.allclose(tr.forest_attributions(forest, odd, 3), tr.attributions(tr.leaf_paths(forest), odd, 3), atol=1e-12)
