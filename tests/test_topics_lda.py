"""Online LDA: planted topics, inference against the plain iteration, the same model for any partitions."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tarn.operators import topics as tp


def texts(n=240, width=40, seed=4):
    """Two topics of 20 terms each; a text takes 9 of 10 words from its own."""
    rng = np.random.default_rng(seed)
    own = np.r_[np.full(20, 0.9 / 20), np.full(20, 0.1 / 20)]
    return np.array([rng.multinomial(60, own if i % 2 else own[::-1]) for i in range(n)])


def frame(spark, counts, parts):
    rows = [(i, Vectors.sparse(len(c), {int(j): float(c[j]) for j in np.flatnonzero(c)})) for i, c in enumerate(counts)]
    return spark.createDataFrame(rows, ["email_id", "features"]).repartition(parts)


def plain_mix(c, weights, alpha, moved):
    at = np.flatnonzero(c)
    g, n = np.ones(weights.shape[1]), c[at].astype(float)
    for _ in range(100_000):
        theta = np.exp(tp.digamma(g) - tp.digamma(g.sum()))
        new = theta * (weights[at].T @ (n / (weights[at] @ theta))) + alpha
        done, g = np.abs(new - g).mean() < moved, new
        if done:
            return g


def test_mixes_equal_the_plain_iteration():
    counts, rng = texts(30), np.random.default_rng(1)
    counts[3] = 0
    counts[4] *= 9
    weights = tp.LdaModel(rng.gamma(2.0, 1.0, (3, 40)), 0.1, 0.01).weights()
    doc, idx = np.nonzero(counts)
    got, _ = tp.topic_mixes(np.bincount(doc, minlength=30), idx, counts[doc, idx].astype(float), weights, 0.1)
    want = np.array([plain_mix(c, weights, 0.1, 1e-9) if c.any() else np.full(3, 0.1) for c in counts])
    assert np.allclose(got / got.sum(axis=1, keepdims=True), want / want.sum(axis=1, keepdims=True), atol=0.01)


def test_planted_topics_are_found_whatever_the_partitions(spark):
    counts = texts()
    one, many = (tp.lda_fit(frame(spark, counts, p), 2, passes=30) for p in (1, 7))
    assert np.allclose(one.topics, many.topics, rtol=1e-6)
    share = one.topics / one.topics.sum(axis=1, keepdims=True)
    assert sorted(share[:, :20].sum(axis=1).round(1)) == [0.1, 0.9]
    probs = {r["email_id"]: r["probs"] for r in tp.lda_topics(one, frame(spark, counts, 3)).collect()}
    assert len(probs) == 240 and {int(np.argmax(probs[i])) for i in range(0, 240, 2)} != {int(np.argmax(probs[i])) for i in range(1, 240, 2)}
    assert all(sum(p) == pytest.approx(1) for p in probs.values())


def test_quality_is_no_worse_than_that_of_mllib(spark):
    from pyspark.ml.clustering import LDA

    counts = texts()
    v = frame(spark, counts, 2).cache()
    mllib = LDA(k=2, maxIter=30, subsamplingRate=1.0, optimizer="online", optimizeDocConcentration=False, docConcentration=[0.1] * 2,
                topicConcentration=0.01, learningOffset=50.0, seed=42).fit(v)
    own = tp.lda_quality(tp.lda_fit(v, 2, passes=30), v).first()
    assert own["log_perplexity"] <= mllib.logPerplexity(v) + 0.01
    # the bound itself: MLlib's topics give MLlib's bound
    same = tp.lda_quality(tp.LdaModel(mllib.topicsMatrix().toArray().T, 0.1, 0.01), v).first()
    assert same["log_likelihood"] == pytest.approx(mllib.logLikelihood(v), rel=1e-3)
