"""Density clusters of vectors against comparing all pairs."""

import numpy as np
import pytest

from tarn.operators import density as ds


def brute_force(x, eps, m, size):
    """Cluster (smallest core row, -1 for noise) and strength of every row."""
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    near = d <= eps
    core = near.sum(1) >= m
    label = np.full(len(x), -1)
    for i in np.flatnonzero(core):
        todo = [i] if label[i] < 0 else []
        while todo:
            j = todo.pop()
            if label[j] < 0:
                label[j] = i
                todo.extend(np.flatnonzero(near[j] & core & (label < 0)))
    strength = np.where(core, 1.0, 0.0)
    for i in np.flatnonzero(~core):
        reach = np.flatnonzero(near[i] & core)
        if len(reach):
            best = reach[d[i][reach].argmin()]
            label[i], strength[i] = label[best], 1 - d[i][best] / eps
    for c in set(label) - {-1}:
        if (label == c).sum() < size:
            strength[label == c] = 0.0
            label[label == c] = -1
    return label, strength


def planted():
    rng = np.random.default_rng(21)
    blob = rng.normal(0, 0.01, (120, 8))  # far more rows than a block, all within eps / 2
    wide = rng.normal(3, 0.5, (150, 8))
    line = np.linspace(0, 6, 60)[:, None] * np.eye(8)[:1] - 4  # a chain that runs through many leaves
    few = rng.normal(-9, 0.05, (4, 8))
    noise = rng.uniform(-6, 6, (40, 8))
    copies = np.repeat(rng.uniform(6, 8, (1, 8)), 50, axis=0)  # one vector of its own, often enough to be a cluster
    return np.r_[blob, wide, line, few, noise, copies]


@pytest.mark.parametrize("block_rows", [16, 1024])
def test_equals_all_pairs_in_eight_dimensions(spark, block_rows):
    x, eps, m, size = planted(), 1.0, 6, 10
    order = np.random.default_rng(5).permutation(len(x))
    x = x[order]
    df = spark.createDataFrame(list(enumerate(x.tolist())), "email_id long, embedding array<double>")
    got = ds.density_cluster_vectors(df, eps, m, size, block_rows=block_rows).toPandas().sort_values("email_id")
    label, strength = brute_force(x, eps, m, size)
    assert got["embedding_cluster"].tolist() == label.tolist()
    assert np.allclose(got["cluster_probability"], strength)
    assert len(set(label)) >= 5 and (strength[label >= 0] < 1).any()


def test_missing_vectors_are_noise_and_empty_tables_stay_empty(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.1]), (3, None), (4, [float("nan"), 0.0]), (5, [None, 1.0]), (6, [0.1, 0.0])]
    df = spark.createDataFrame(rows, "email_id long, embedding array<double>")
    got = {r.email_id: (r.embedding_cluster, r.cluster_probability) for r in ds.density_cluster_vectors(df, 0.5, 3, 3).collect()}
    assert got == {1: (1, 1.0), 2: (1, 1.0), 6: (1, 1.0), 3: (-1, 0.0), 4: (-1, 0.0), 5: (-1, 0.0)}
    assert ds.density_cluster_vectors(df.limit(0), 0.5, 3, 3).count() == 0
    assert ds.density_cluster_vectors(df.filter("email_id = 3"), 0.5, 3, 3).collect()[0].embedding_cluster == -1


@pytest.mark.parametrize("shift,single", [(0.0, True), (1e5, False)])
def test_single_products_give_the_pairs_of_plain_differences(monkeypatch, shift, single):
    """Pairs at the limit included; vectors far from the origin and from each other are not compared in single precision."""
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(size=(300, 12)), np.eye(12) * 4, np.zeros((1, 12))] + shift
    x[:5] += 1e6 * (shift > 0)
    calls, plain = [], ds._squares
    monkeypatch.setattr(ds, "_squares", lambda a, b: calls.append(len(a)) or plain(a, b))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.array_equal(ds._within(x, x, 4.0), d <= 4.0) and (d == 4.0).any()
    assert (not calls) == single


def test_blocks_meet_in_groups(spark, monkeypatch):
    """A task takes a group of blocks on each side, not a pair of blocks."""
    x = np.random.default_rng(4).normal(size=(400, 8))
    df = spark.createDataFrame(list(enumerate(x.tolist())), "email_id long, embedding array<double>")
    met, plain = [], ds._meet
    monkeypatch.setattr(ds, "_meet", lambda left, right, pairs, *rest: met.append(pairs.count()) or plain(left, right, pairs, *rest))
    got = ds.density_cluster_vectors(df, 1.5, 4, 5, block_rows=16).toPandas().sort_values("email_id")
    label, strength = brute_force(x, 1.5, 4, 5)
    assert got["embedding_cluster"].tolist() == label.tolist() and np.allclose(got["cluster_probability"], strength)
    assert len(met) == 3 and max(met) <= 81  # at most nine groups, of some thirty blocks
