"""Properties of the fitted models on small planted data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarn.operators import clusters as cl
from tarn.operators import forest as fo
from tarn.operators import neighbours as nb
from tarn.operators import topics as tp
from tarn.operators import trees as tr
from tarn.operators.seasonal import residual

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    x[:6] += 9
    pdf = pd.DataFrame(x, columns=COLS).assign(login_id=np.arange(400), user_id=np.r_[np.full(381, 1), np.full(19, 2)])
    return spark.createDataFrame(pdf).cache()


def test_forest_ranks_outliers_and_attributions_add_up(planted):
    nodes = fo.iforest_fit(planted, COLS, n_trees=60, n_sub=64)
    scored = fo.iforest_decision(fo.iforest_score(planted, nodes, COLS), 0.05).toPandas().sort_values("iforest")
    assert set(scored["login_id"].head(6)) == set(range(6))
    assert 0 < scored["is_anomaly"].sum() <= 21
    forest = fo.load_forest(nodes)
    x = planted.toPandas()[COLS].to_numpy()[:20]
    phi = tr.attributions(tr.leaf_paths(forest), x, 3)
    assert np.allclose(phi.sum(axis=1) + tr.leaf_paths(forest).base, tr.path_lengths(forest, x))
    again = fo.iforest_score(planted, fo.iforest_fit(planted, COLS, n_trees=60, n_sub=64), COLS).toPandas().sort_values("iforest")
    assert again["iforest"].tolist() == scored["iforest"].tolist()


def test_per_user_chunks_do_not_change_scores(planted, monkeypatch):
    whole = fo.per_user_scores(planted, COLS, n_trees=20).toPandas().set_index("login_id").sort_index()
    monkeypatch.setattr(fo, "CHUNK_ROWS", 100)
    split = fo.per_user_scores(planted, COLS, n_trees=20).toPandas().set_index("login_id").sort_index()
    assert np.allclose(whole["per_user_score"], split["per_user_score"])
    small = whole[whole["user_id"] == 2]
    assert (small["per_user_score"] == 0).all() and (small["per_user_anomaly"] == 0).all()
    assert whole.loc[:5, "per_user_anomaly"].sum() >= 4
    tops = fo.per_user_explain(planted, fo.per_user_scores(planted, COLS, n_trees=20), COLS, 2, n_trees=20)
    flagged = tops.filter("per_user_anomaly = 1")
    assert flagged.filter("top1_feature IS NULL").count() == 0
    assert tops.count() == 400


def test_neighbours_with_copies_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(150, 3)), 3)
    x[50:100] = x[50]                      # a third of the rows are copies
    ids = np.arange(150)
    df = spark.createDataFrame(list(zip(ids.tolist(), x.tolist())), "id long, v array<double>")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    order = np.lexsort((np.broadcast_to(ids, d.shape), d), axis=1)[:, :5]
    edges = nb.knn_edges(df, "id", "v", 5).toPandas().sort_values(["id", "rank"])
    assert len(edges) == 750
    assert np.array_equal(edges["nbr"].to_numpy().reshape(150, 5), order)
    knn = nb.knn_score(df, "id", "v", 5).toPandas().sort_values("id")["knn"].to_numpy()
    assert np.allclose(knn, np.take_along_axis(d, order, axis=1).mean(axis=1))
    vectors = nb.distinct_vectors(df, "id", "v", 5)
    small_blocks = nb.vector_neighbours(vectors, 5, block_rows=10, pivots=6).toPandas()
    one_block = nb.vector_neighbours(vectors, 5, pivots=1).toPandas()
    key = ["vid", "rank"]
    assert small_blocks.sort_values(key)["nbr"].tolist() == one_block.sort_values(key)["nbr"].tolist()


def _dbscan(p, eps, m):
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1))
    near = d <= eps
    core = near.sum(1) >= m
    label = np.full(len(p), -1)
    c = 0
    for i in np.flatnonzero(core):
        if label[i] < 0:
            todo, label[i] = [i], c
            while todo:
                j = todo.pop()
                for k in np.flatnonzero(near[j] & core & (label < 0)):
                    label[k] = c
                    todo.append(k)
            c += 1
    return core, label, d


def test_density_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    p = np.r_[rng.normal([0, 0], .3, (100, 2)), rng.normal([3, 0], .3, (100, 2)), rng.normal([0, 3], .3, (100, 2)),
              rng.uniform(-6, 8, (20, 2))]
    eps, m = 0.35, 8
    df = spark.createDataFrame(pd.DataFrame({"email_id": np.arange(len(p)), "x": p[:, 0], "y": p[:, 1]}))
    got = cl.density_cluster(df, eps, m, min_size=30).toPandas().sort_values("email_id")
    core, label, d = _dbscan(p, eps, m)
    sizes = {}
    mine = got["embedding_cluster"].to_numpy()
    for i in range(len(p)):
        if core[i]:
            want = label[i]
        else:
            reach = np.where(core & (d[i] <= eps))[0]
            want = label[reach[np.argmin(d[i][reach])]] if len(reach) else -1
        sizes.setdefault(want, []).append(i)
    for want, members in sizes.items():
        found = set(mine[members])
        assert len(found) == 1
        assert (found == {-1}) == (want == -1 or len(members) < 30)
    assert len(set(mine)) == 4
    strength = got["cluster_probability"].to_numpy()
    assert ((strength >= 0) & (strength <= 1)).all() and (strength[core & (mine != -1)] == 1).all()


def test_components_of_a_long_chain(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1)] + [(100, 101)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in [*range(n), 100, 101, 500]], "node long")
    got = {r["node"]: r["component"] for r in cl.connected_components(nodes, edges).collect()}
    assert {got[i] for i in range(n)} == {0} and got[101] == 100 and got[500] == 500


def test_factor_error_never_rises_and_finds_blocks(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(60):
        terms = range(0, 10) if i % 2 else range(10, 20)
        rows.append((i, list(terms), [float(v) for v in rng.uniform(0.5, 1.0, 10)]))
    df = spark.createDataFrame(rows, "email_id long, idx array<int>, val array<double>")
    fits = tp.nmf_sweep(df, [2, 3], 20, iters=6)
    for fit in fits.values():
        assert all(b <= a + 1e-6 for a, b in zip(fit["history"], fit["history"][1:]))
    top = tp.dominant_topic(tp.nmf_transform(df, fits[2]["h"])).toPandas().sort_values("email_id")["dominant_topic"].to_numpy()
    assert len(set(top[::2])) == 1 and len(set(top[1::2])) == 1 and top[0] != top[1]


def test_entropy_of_certain_and_uniform_mix(spark):
    df = spark.createDataFrame([([1.0, 0.0],), ([0.5, 0.5],)], "probs array<double>")
    h = [r["lda_entropy"] for r in tp.topic_entropy(df).collect()]
    assert h[0] == 0 and h[1] == pytest.approx(np.log(2))


def test_decomposition():
    i = np.arange(288 * 10)
    y = 5 + 0.001 * i + 2 * np.sin(2 * np.pi * i / 288) + np.random.default_rng(8).normal(0, 0.05, len(i))
    y[1000] += 8
    r = residual(y, 288)
    assert abs(r[1000] - 8) < 0.5 and np.abs(np.delete(r, 1000)).max() < 0.5
    assert (residual(np.full(1000, 3.0), 288) == 0).all()


def test_documents_without_terms_keep_a_row(spark):
    from tarn.operators import tokens as tk

    rows = [(i, "alpha beta gamma delta alpha" if i % 2 else "omega sigma theta omega kappa") for i in range(12)] + [(90, ""), (91, None), (92, "zzz")]
    docs = spark.createDataFrame(rows, "email_id long, body string")
    counts = tk.term_counts(tk.tokens(docs))
    vocab = tk.vocabulary(counts, len(rows))
    matrix = tk.count_matrix(counts, vocab)
    sparse = tk.every_document(tk.document_rows(tk.tfidf(matrix, len(rows))), docs)
    assert {r["email_id"]: len(r["idx"]) for r in sparse.collect()}[90] == 0 and sparse.count() == len(rows)
    fit = tp.nmf_fit(sparse, 2, vocab.count())
    assert len(fit["history"]) < 100 and fit["history"][-2] - fit["history"][-1] < 1e-4 * fit["history"][0]
    weights = {r["email_id"]: list(r["weights"]) for r in tp.nmf_transform(sparse, fit["h"]).collect()}
    assert len(weights) == len(rows) and weights[92] == [0.0, 0.0]
    v = tp.count_vectors(tk.every_document(tk.term_lists(matrix), docs), "terms", vocab).select("email_id", "features").cache()
    model = tp.lda_fit(v, 2, passes=10)
    probs = {r["email_id"]: list(r["probs"]) for r in tp.lda_topics(model, v).collect()}
    assert probs[91] == [0.5, 0.5] and len(probs) == len(rows)
    assert max(probs[1]) > 0.6 and np.argmax(probs[1]) == np.argmax(probs[3]) != np.argmax(probs[2])
    q = tp.lda_quality(model, v).first()
    assert q["log_likelihood"] < 0 and q["perplexity"] == pytest.approx(np.exp(q["log_perplexity"]))


def test_forest_sampling_is_one_scheme(spark):
    from tarn.operators.forest import iforest_fit

    small = spark.range(400).selectExpr("id as login_id", "cast(id % 17 as double) as x", "cast(id % 5 as double) as y")
    large = spark.range(4000).selectExpr("id as login_id", "cast(id % 17 as double) as x", "cast(id % 5 as double) as y")
    for df, n in ((small, 400), (large, 4000)):
        nodes = iforest_fit(df, ["x", "y"], n_trees=20, n_sub=32).toPandas()
        roots = nodes[nodes["parent"] < 0]
        assert sorted(roots["tree_id"]) == list(range(20)) and (roots["size"] == 32).all()


def test_ensemble_with_the_forest_of_the_same_vectors(spark, tmp_path):
    from tarn import catalog

    x = np.random.default_rng(4).normal(size=(60, 4))
    x[7] += 12
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = catalog.queries()
    got = found["od_ensemble_iforest"](spark, str(tmp_path)).toPandas().set_index("vec_id").sort_index()
    plain = found["od_ensemble"](spark, str(tmp_path)).toPandas().set_index("vec_id").sort_index()
    assert got["ensemble_score"].tolist() == plain["ensemble_score"].tolist()
    forest = 2 * got["ensemble_with_iforest"] - got["ensemble_score"]
    assert len(got) == 60 and forest.idxmax() == 7 and abs(forest.max() - 1) < 1e-5 and abs(forest.min()) < 1e-5


def _sparse(spark, x):
    return spark.createDataFrame([(i, [int(j) for j in np.flatnonzero(r)], [float(v) for v in r[np.flatnonzero(r)]]) for i, r in enumerate(x)],
                                 "email_id long, idx array<int>, val array<double>").repartition(4)


def test_truncated_svd_and_its_start(spark):
    rng = np.random.default_rng(8)
    x = rng.random((60, 4)) @ (rng.random((4, 25)) * (rng.random((4, 25)) < 0.5)) + 0.05 * (rng.random((60, 25)) < 0.2)
    rows = _sparse(spark, x)
    values, v = tp.truncated_svd(rows, 25, 4)
    _, want, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(values, want[:4], rtol=1e-5)
    assert np.allclose(np.abs((v * vt[:4].T).sum(axis=0)), 1, atol=1e-4)
    h = tp.svd_start(rows, 25, 4, steps=30)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    for j in range(1, 4):
        sides = [(np.linalg.norm(np.maximum(f * u[:, j], 0)), np.maximum(f * vt[j], 0)) for f in (1, -1)]
        left, right = max(sides, key=lambda t: t[0] * np.linalg.norm(t[1]))
        mine = np.sqrt(s[j] * left / np.linalg.norm(right)) * right
        assert np.allclose(h[j], np.where(mine < 1e-6, x.mean(), mine), atol=1e-3)
    assert np.allclose(tp.svd_start(rows.repartition(2), 25, 4, steps=30), h, atol=1e-6)
    topics = np.kron(np.eye(3), np.ones((1, 8))) * (0.2 + rng.random((3, 24)))
    rows = _sparse(spark, np.where(rng.random((90, 3)) < 0.5, rng.random((90, 3)), 0) @ topics + 0.02 * (rng.random((90, 24)) < 0.1))
    mine, random = (tp.nmf_sweep(rows, [2, 3], 24, iters=40, start=w) for w in ("svd", "random"))
    for k in (2, 3):
        assert mine[k]["history"][0] < random[k]["history"][0]
        assert mine[k]["error"] <= random[k]["error"] * 1.01, (mine[k]["history"], random[k]["history"])


def test_svd_start_of_poor_matrices(spark):
    one = tp.svd_start(_sparse(spark, np.ones((3, 4))), 4, 3)  # rank 1, more topics than rows have directions
    assert one.shape == (3, 4) and np.allclose(one[0], np.sqrt(np.sqrt(12)) / 2) and (one >= 0).all()
    assert (tp.svd_start(_sparse(spark, np.zeros((2, 3))), 3, 2) == 0).all()


def _clusters(spark, n, centres, seed=5):
    rng = np.random.default_rng(seed)
    at = rng.normal(scale=100, size=(centres, 6))
    x = at[rng.integers(0, centres, n)] + rng.normal(scale=0.5, size=(n, 6))
    return x, spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>")


def test_metric_tree_splits_by_distance_and_stays_exact(spark):
    x, df = _clusters(spark, 700, 12)
    vectors = nb.distinct_vectors(df, "id", "v", 4).cache()
    placed, centres = nb.metric_tree(vectors, block_rows=30, pivots=2)
    leaves = placed.toPandas().groupby("leaf")["radius"].agg(["size", "max"])
    assert leaves["size"].sum() == 700 and leaves["size"].max() <= 90 and set(leaves.index) <= set(centres)
    assert leaves["max"].median() < 10  # a leaf is a small ball, not a random part of a large one
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    np.fill_diagonal(d, np.inf)
    want = {(i, int(j)) for i in range(700) for j in np.argsort(d[i], kind="stable")[:4]}
    for args in ({"block_rows": 30, "pivots": 2}, {"block_rows": 30, "pivots": 2, "seed": 9}):
        got = nb.vector_neighbours(vectors, 4, **args).toPandas()
        assert set(zip(got["vid"], got["nbr"])) == want
    few, _ = nb.metric_tree(vectors, block_rows=30, pivots=2, most=5)
    assert few.count() == 700 and few.select("leaf").distinct().count() <= 5


def test_meetings_grow_slower_than_the_square(spark):
    """Twice the clusters, so twice the leaves: meetings grow with the leaves, not with their pairs."""
    counts = []
    for n, clusters in ((400, 8), (800, 16)):
        _, df = _clusters(spark, n, clusters)
        vectors = nb.distinct_vectors(df, "id", "v", 3)
        placed, centres = nb.metric_tree(vectors, block_rows=50, pivots=4)
        bounded = placed.withColumn("block", F.col("leaf").cast("string")).withColumn("reach", F.lit(2.0)).cache()
        leaves = bounded.select("block").distinct().count()
        counts.append((leaves, nb.meetings(bounded, centres).count()))
    assert counts[1][1] < 3 * counts[0][1] and counts[1][1] < 0.5 * counts[1][0] ** 2


def test_one_search_gives_both_scores(spark):
    rng = np.random.default_rng(2)
    x = np.repeat(rng.normal(size=(60, 3)), 2, axis=0)[:90].tolist()
    df = spark.createDataFrame(list(enumerate(x)), "id long, v array<double>")
    both = {r["id"]: (r["knn"], r["lof"]) for r in nb.neighbour_scores(df, "id", "v", 4, 9).collect()}
    knn = {r["id"]: r["knn"] for r in nb.knn_score(df, "id", "v", 4).collect()}
    lof = {r["id"]: r["lof"] for r in nb.lof_score(df, "id", "v", 9).collect()}
    assert both.keys() == knn.keys() == lof.keys()
    assert all(both[i] == pytest.approx((knn[i], lof[i])) for i in both)


def test_texts_counted_in_their_rows_equal_the_long_tables(spark, monkeypatch):
    """Repeated ids, missing ids, texts without terms; the ids that occur once take no part in the long tables."""
    from tarn.catalog import texts
    from tarn.operators import clusters as cl
    from tarn.operators import tokens as tk

    rng = np.random.default_rng(4)
    words = ["alpha", "beta", "gamma", "delta", "omega", "the", "x", "sigma7"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 40)))) for i in range(60)]
    rows += [(3, "alpha beta beta"), (3, "alpha omega"), (None, "beta gamma"), (None, "gamma"), (900, ""), (901, None), (902, "the")]
    rows += [(903, "See HTTP://a.b/c?d www.x\x0by.z me@ex.co\u212a \u0130stanbul na\u00efve\u2003\u00a0one\x0btwo it's x9_y\n\nTab\there  \u00c5ngstr\u00f6m http a@b c@d. e@f.g."),
             (904, "www. http: @a.b a@.b. \x85 end\x1cof\x0cfile \ufeffbom \U0001d4d0script caf\u00e9s")]
    docs = spark.createDataFrame(rows, "email_id long, body string")
    monkeypatch.setattr(texts, "emails", lambda spark, d: docs)
    monkeypatch.setattr(tk, "SLICE_BYTES", 200)
    seen, plain = [], tk.term_counts
    monkeypatch.setattr(tk, "term_counts", lambda tok, *a: seen.extend(r[0] for r in tok.select("email_id").distinct().collect()) or plain(tok, *a))
    c = texts.Corpus(spark, "")
    assert set(seen) == {3, None}
    counts = plain(tk.tokens(docs))
    vocab = tk.vocabulary(counts, len(rows))
    key = lambda df, *cols: sorted(((tuple(r)) for r in df.select(*cols).collect()), key=str)
    assert key(c.vocab, "term_id", "term", "df", "total") == key(vocab, "term_id", "term", "df", "total")
    matrix = tk.count_matrix(counts, vocab)
    assert key(c.matrix, "email_id", "term_id", "term", "tf", "df") == key(matrix, "email_id", "term_id", "term", "tf", "df")
    weights = tk.tfidf(matrix, F.lit(len(rows)))
    rounded = ("email_id", "term_id", "term", F.round("tfidf", 12))
    assert key(c.tfidf(), *rounded) == key(weights, *rounded)
    old = tk.every_document(tk.document_rows(weights), docs)
    short = ("email_id", "idx", F.transform("val", lambda v: F.round(v, 12)))
    assert key(c.rows(), *short) == key(old, *short)
    figures = tk.tokens(docs).groupBy("email_id").agg(F.count("term").alias("n_terms"), F.countDistinct("term").alias("n_distinct"),
                                                      F.min("term").alias("first_term"), F.max("term").alias("last_term"))
    assert key(tk.term_figures(docs), *figures.columns) == key(figures, *figures.columns)
    assert key(cl.embed_hashed(docs, width=32), "email_id", "embedding") == key(cl._embed_by_id(docs, "email_id", "body", 32), "email_id", "embedding")
    plan = tk.term_figures(docs.filter("email_id > 3"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # texts with ids of their own are not shuffled


def test_neighbours_far_from_the_origin_and_over_many_groups(spark, monkeypatch):
    """Matrix products only sort out: ties, tiny gaps far from 0 and vectors of many groups come out as by plain differences."""
    rng = np.random.default_rng(8)
    x = np.r_[rng.normal(size=(300, 6)), rng.integers(0, 3, (100, 6)), 1e6 + rng.normal(0, 1e-3, (100, 6))]
    x = np.unique(x, axis=0)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vid long, vec array<double>")
    monkeypatch.setattr(nb, "TILE_SHARE", 5)
    seen, plain = [], nb._distances
    got = nb.vector_neighbours(df, 7, block_rows=16).toPandas().sort_values(["vid", "rank"])
    d = plain(x, x)
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, :7]
    assert got["nbr"].tolist() == order.ravel().tolist()
    assert np.allclose(got["dist"], np.take_along_axis(d, order, axis=1).ravel(), rtol=1e-12, atol=0)
    found = nb._Nearest(np.arange(200), x[:200], np.full(200, np.inf), 7)
    monkeypatch.setattr(nb, "_distances", lambda a, b: seen.append(a.shape[0] * b.shape[0]) or plain(a, b))
    found.look(np.arange(len(x)), x, x.mean(axis=0), np.array([0.0, 1e9]))
    assert sum(seen) <= 200 and len(found.found()) == 1400  # plain differences to the centre alone


def _as_group(x, first, k, block_rows=64):
    import pandas as pd

    block = np.arange(len(x)) // block_rows
    with np.errstate(all="ignore"):
        centres = {int(b): np.nan_to_num(x[block == b], posinf=0, neginf=0).mean(axis=0) for b in np.unique(block)}
        radius = [float(np.sqrt(((v - centres[int(b)]) ** 2).sum())) for v, b in zip(x, block)]
    pdf = pd.DataFrame({"vid": np.arange(first, first + len(x)), "vec": list(x), "leaf": block, "block": block.astype(str), "radius": radius})
    return nb._Group(pdf, np.full(len(x), np.inf), k, centres)


@pytest.mark.parametrize("scale", [1.0, 1e-30, 1e25])
def test_two_groups_meet_once_for_both_sides(monkeypatch, scale):
    """One product for each pair of blocks, in single precision where its rounding is small; neighbours are those of plain differences."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 24))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) * scale
    x[400] = x[3]  # a distance of zero across the groups
    k, cells, kinds = 6, [], []
    a, b = _as_group(x[:230], 0, k), _as_group(x[230:], 230, k)
    a.meet_itself(), b.meet_itself(), a.merge(), b.merge()
    matmul = np.matmul
    monkeypatch.setattr(np, "matmul", lambda p, q, out: (cells.append(len(p) * q.shape[1]), kinds.append(out.dtype.name)) and matmul(p, q, out=out))
    a.meet(b)
    if scale == 1.0:
        assert set(kinds) == {"float32"}
    assert sum(cells) <= 230 * 270
    d = nb._distances(x, x)
    np.fill_diagonal(d, np.inf)
    want = np.lexsort((np.broadcast_to(np.arange(500), d.shape), d), axis=1)[:, :k]
    got = {int(g.ids[r]): n.tolist() for g in (a, b) for r, n in zip(*g.lists()[:2])}
    assert [got[i] for i in range(500)] == want.tolist()


def test_vectors_that_are_not_finite_keep_their_old_neighbours():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 5))
    x[7, 2], x[200, 0] = np.inf, np.nan
    a, b = _as_group(x[:150], 0, 4), _as_group(x[150:], 150, 4)
    a.meet_itself(), b.meet_itself(), a.meet(b)
    got = {int(g.ids[r]): n.tolist() for g in (a, b) for r, n in zip(*g.lists()[:2])}
    d = nb._distances(x, x)
    np.fill_diagonal(d, np.inf)
    plain = [i for i in range(300) if i not in (7, 200)]
    want = np.argsort(np.where(np.isfinite(d), d, np.inf), axis=1, kind="stable")[:, :4]
    assert [got[i] for i in plain] == want[plain].tolist() and 200 not in got


def test_attributions_of_many_rows_are_looked_up(monkeypatch):
    rng = np.random.default_rng(6)
    x = np.c_[rng.normal(size=(900, 2)), rng.integers(0, 2, 900)]
    forest = tr.grow(x, [rng.permutation(900)[:n] for n in (256, 256, 40, 1)], 256, rng)
    x[5, 1], x[6] = np.nan, np.inf
    paths = tr.leaf_paths(forest)
    want = np.vstack([tr.attributions(paths, x[i:i + 100], 3) for i in range(0, 900, 100)])
    plain, rows = tr._attributions_by_row, []
    monkeypatch.setattr(tr, "_attributions_by_row", lambda p, v, *more: rows.append(len(v)) or plain(p, v, *more))
    got = tr.attributions(paths, x, 3)
    assert rows == [1]  # the row with NaN
    assert np.allclose(got, want, rtol=1e-12, atol=1e-12)


def test_explained_rows_are_dealt_over_partitions(planted):
    nodes = fo.iforest_fit(planted, COLS, n_trees=20, n_sub=64)
    tops = fo.explain(planted.coalesce(1), nodes, COLS, 2)
    parts = tops.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts == 8


def test_vectors_and_pairs_of_groups_are_dealt_over_partitions(spark, monkeypatch):
    x = np.random.default_rng(8).normal(size=(300, 4))
    vectors = nb.distinct_vectors(spark.createDataFrame(list(zip(range(300), x.tolist())), "id long, v array<double>"), "id", "v", 3)
    placed, _ = nb.metric_tree(vectors.coalesce(1), block_rows=40)
    assert placed.select(F.spark_partition_id()).distinct().count() == 8
    counts, plain = [], nb.spread
    monkeypatch.setattr(nb, "spread", lambda df, *keys, **more: counts.append(plain(df, *keys, **more).rdd.getNumPartitions()) or plain(df, *keys, **more))
    found = nb.vector_neighbours(vectors, 3, block_rows=20).collect()
    assert max(counts) >= 2 * 28  # eight groups or more meet in pairs
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for r in found:
        assert abs(r["dist"] - np.sort(d[r["vid"]])[r["rank"] - 1]) < 1e-12
    assert len(found) == 900
