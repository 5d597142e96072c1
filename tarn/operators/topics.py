"""Topic models: non-negative factors over distributed rows, LDA, and what is read from them."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.operators.sequences import top_per_group


def _row_factors(pdf: pd.DataFrame, h: np.ndarray, sweeps: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Non-negative least squares of every sparse row on the factors ``h`` (topics x terms)."""
    idx, val, doc = _flat(pdf)
    xh = np.zeros((len(pdf), len(h)))
    for j in range(len(h)):
        xh[:, j] = np.bincount(doc, weights=val * h[j, idx], minlength=len(pdf))
    g = h @ h.T
    w = np.zeros_like(xh)
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(h)):
            if g[j, j] <= 0:
                continue
            new = np.maximum(0.0, w[:, j] - (w @ g[:, j] - xh[:, j]) / g[j, j])
            moved = max(moved, float(np.abs(new - w[:, j]).max(initial=0.0)))
            w[:, j] = new
        if moved < 1e-9:
            break
    return w, idx, val, doc


def _term_factors(a: np.ndarray, b: np.ndarray, h: np.ndarray, sweeps: int = 5) -> np.ndarray:
    h = h.copy()
    for _ in range(sweeps):
        for j in range(len(h)):
            if b[j, j] > 0:
                h[j] = np.maximum(0.0, h[j] + (a[j] - b[j] @ h) / b[j, j])
    return h


def _flat(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term, value and row number of every entry of a batch of sparse rows."""
    if not len(pdf):
        return np.zeros(0, int), np.zeros(0), np.zeros(0, int)
    sizes = pdf["idx"].map(len).to_numpy()
    return (np.concatenate([np.asarray(v, dtype=int) for v in pdf["idx"]]), np.concatenate([np.asarray(v, dtype=float) for v in pdf["val"]]),
            np.repeat(np.arange(len(pdf)), sizes))


def _projected(pdf: pd.DataFrame, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The batch times ``v`` (terms x columns), and its entries."""
    idx, val, doc = _flat(pdf)
    xv = np.stack([np.bincount(doc, weights=val * v[idx, j], minlength=len(pdf)) for j in range(v.shape[1])], axis=1)
    return xv, idx, val, doc


def _gram_times(rows: DataFrame, v: np.ndarray) -> np.ndarray:
    """XtX times ``v`` in one pass over the rows of X; the sums are added in the JVM by (column, term)."""
    shared = rows.sparkSession.sparkContext.broadcast(v)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros_like(shared.value)
        for pdf in batches:
            xv, idx, val, doc = _projected(pdf, shared.value)
            for j in range(out.shape[1]):
                out[:, j] += np.bincount(idx, weights=val * xv[doc, j], minlength=len(out))
        term, column = np.nonzero(out)
        yield pd.DataFrame({"term": term, "col": column, "value": out[term, column]})

    got = rows.mapInPandas(sums, "term int, col int, value double").groupBy("term", "col").agg(F.sum("value").alias("value")).toPandas()
    shared.unpersist()
    out = np.zeros_like(v)
    out[got["term"], got["col"]] = got["value"]
    return out


def truncated_svd(rows: DataFrame, n_terms: int, k: int, steps: int = 30, extra: int = 8, seed: int = 42, tolerance: float = 1e-7) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest singular values of the rows (idx, val) and their right vectors (terms x k).

    Subspace iteration on the Gram matrix: a pass multiplies the broadcast vectors by XtX, the driver makes the result orthonormal. Only
    (terms x (k + ``extra``)) numbers travel, whatever the number of rows. It stops when no wanted value moves by more than
    ``tolerance`` of the largest one.
    """
    width = min(k + extra, n_terms)
    v, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))
    last = np.zeros(min(k, width))
    for _ in range(steps):
        y = _gram_times(rows, v)
        own, turn = np.linalg.eigh(v.T @ y)
        values = np.sqrt(np.maximum(own[::-1], 0.0))[:len(last)]
        vectors = (v @ turn[:, ::-1])[:, :len(last)]
        v, _ = np.linalg.qr(y)
        if np.abs(values - last).max(initial=0.0) <= tolerance * max(values.max(initial=0.0), 1e-300):
            break
        last = values
    return values, vectors


def svd_start(rows: DataFrame, n_terms: int, k: int, seed: int = 42, steps: int = 3) -> np.ndarray:
    """Non-negative double-SVD start (topics x terms), the same for every run; entries that would be 0 get the mean of all cells.

    Of each singular pair the side, positive or negative, with the larger product of norms is taken. The first rows are the start for
    fewer topics, so one start serves all K of a sweep. A few ``steps`` are enough: the factors are refined from here.
    """
    values, v = truncated_svd(rows, n_terms, k, steps, extra=4, seed=seed, tolerance=1e-3)
    shared = rows.sparkSession.sparkContext.broadcast(v)

    def norms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        up, down, total, n = np.zeros(v.shape[1]), np.zeros(v.shape[1]), 0.0, 0
        for pdf in batches:
            xv, _, val, _ = _projected(pdf, shared.value)
            up += (np.maximum(xv, 0) ** 2).sum(axis=0)
            down += (np.minimum(xv, 0) ** 2).sum(axis=0)
            total, n = total + val.sum(), n + len(pdf)
        yield pd.DataFrame({"col": [*range(len(up)), -1], "up": [*up, total], "down": [*down, float(n)]})

    got = rows.mapInPandas(norms, "col int, up double, down double").groupBy("col").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).toPandas().set_index("col")
    shared.unpersist()
    h = np.zeros((k, n_terms))
    if len(got):
        for j in range(len(values)):
            if values[j] <= 0:
                continue
            # left vectors are X v / s: their norms are known from one pass, they themselves are not needed
            sides = [(np.sqrt(got.loc[j, "up"]) / values[j], np.maximum(v[:, j], 0)), (np.sqrt(got.loc[j, "down"]) / values[j], np.maximum(-v[:, j], 0))]
            left, right = max(sides, key=lambda s: s[0] * np.linalg.norm(s[1]))
            if j == 0:
                h[j] = np.sqrt(values[j]) * np.abs(v[:, j])
            elif np.linalg.norm(right) > 0:
                h[j] = np.sqrt(values[j] * left * np.linalg.norm(right)) * right / np.linalg.norm(right)
        cells = got.loc[-1, "down"] * n_terms
        h[h < 1e-6] = got.loc[-1, "up"] / cells if cells else 0.0
    return h


def nmf_sweep(rows: DataFrame, ks: Sequence[int], n_terms: int, iters: int = 500, seed: int = 42,
              factors: dict[int, np.ndarray] | None = None, tolerance: float = 1e-4, start: str = "svd") -> dict[int, dict[str, object]]:
    """Factors, error and error history for every K, all K fitted in the same passes.

    A pass solves every document row against the broadcast factors and sums WtX and
    WtW; the sums are added in the JVM by (k, topic, column), so no task holds the
    numbers of many partitions. Rows are solved afresh, so the error cannot rise
    between passes. All K begin from one ``svd_start`` (``start="random"``: from seeded
    numbers) unless ``factors`` are given. A model is done when its error drops by less than
    ``tolerance`` of its first error, or after ``iters`` passes.
    """
    spark = rows.sparkSession
    norm2 = rows.select(F.sum(F.aggregate("val", F.lit(0.0), lambda s, v: s + v * v)).alias("x")).first()["x"] or 0.0
    rng = np.random.default_rng(seed)
    given = factors or {}
    wanted = [k for k in ks if k not in given]
    first = svd_start(rows, n_terms, max(wanted), seed) if wanted and start == "svd" and n_terms else None
    h = {k: given[k] if k in given else first[:k].copy() if first is not None else rng.random((k, n_terms)) + 0.01 for k in ks}
    history: dict[int, list[float]] = {k: [] for k in ks}
    spent = dict.fromkeys(ks, 0.0)
    active = list(ks)
    while active:
        shared = spark.sparkContext.broadcast({k: h[k] for k in active})

        def sums(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            a = {k: np.zeros((k, n_terms)) for k in shared.value}
            b = {k: np.zeros((k, k)) for k in shared.value}
            for pdf in batches:
                for k in shared.value:
                    w, idx, val, doc = _row_factors(pdf, shared.value[k])
                    b[k] += w.T @ w
                    for j in range(k):
                        a[k][j] += np.bincount(idx, weights=val * w[doc, j], minlength=n_terms)
            for k in shared.value:
                both = np.hstack([a[k], b[k]])  # columns beyond the terms are WtW
                topic, column = np.nonzero(both)
                yield pd.DataFrame({"k": np.full(len(topic), k), "topic": topic, "col": column, "value": both[topic, column]})

        began = time.monotonic()
        got = rows.mapInPandas(sums, "k int, topic int, col int, value double").groupBy("k", "topic", "col").agg(F.sum("value").alias("value")).toPandas()
        shared.unpersist()
        for k in list(active):
            mine = got[got["k"] == k]
            both = np.zeros((k, n_terms + k))
            both[mine["topic"], mine["col"]] = mine["value"]
            a, b = both[:, :n_terms], both[:, n_terms:]
            err2 = norm2 - 2 * float((a * h[k]).sum()) + float((b * (h[k] @ h[k].T)).sum())
            history[k].append(float(np.sqrt(max(err2, 0.0))))
            spent[k] += (time.monotonic() - began) / len(active)
            e = history[k]
            if len(e) > iters or len(e) > 1 and e[-2] - e[-1] < tolerance * e[0]:
                active.remove(k)
            else:
                h[k] = _term_factors(a, b, h[k])
    return {k: {"h": h[k], "error": history[k][-1], "history": history[k], "seconds": spent[k]} for k in ks}


def nmf_fit(rows: DataFrame, k: int, n_terms: int, iters: int = 500, seed: int = 42) -> dict[str, object]:
    return nmf_sweep(rows, [k], n_terms, iters, seed)[k]


def factor_table(rows_spark, h: np.ndarray, vocab: DataFrame) -> DataFrame:
    """(topic, term, weight): the factors as model rows, K x terms of them."""
    pdf = pd.DataFrame({"topic": np.repeat(np.arange(h.shape[0]), h.shape[1]), "term_id": np.tile(np.arange(h.shape[1]), h.shape[0]),
                        "weight": h.ravel()})
    table = rows_spark.createDataFrame(pdf, "topic int, term_id int, weight double")
    return table.join(F.broadcast(vocab.select("term_id", "term")), "term_id").select("topic", "term_id", "term", "weight")


def nmf_transform(rows: DataFrame, h: np.ndarray, id_col: str = "email_id") -> DataFrame:
    """(id, weights): topic weights of every document."""
    shared = rows.sparkSession.sparkContext.broadcast(h)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({id_col: pdf[id_col], "weights": list(_row_factors(pdf, shared.value)[0])})

    return rows.mapInPandas(run, f"{id_col} {dict(rows.dtypes)[id_col]}, weights array<double>")


def sweep_table(spark, fits: dict[int, dict[str, object]], vocab: DataFrame, words: int = 10) -> DataFrame:
    """(k, error, error_drop, seconds, top_words) for reading off the elbow."""
    ks = sorted(fits)
    terms = [r["term"] for r in vocab.select("term_id", "term").orderBy("term_id").collect()]
    out = []
    for i, k in enumerate(ks):
        h = fits[k]["h"]
        best = ["; ".join(" | ".join(terms[t] for t in np.argsort(-row, kind="stable")[:words]) for row in h)]
        drop = fits[ks[i - 1]]["error"] - fits[k]["error"] if i else None
        out.append((k, fits[k]["error"], drop, fits[k]["seconds"], best[0]))
    return spark.createDataFrame(out, "k int, error double, error_drop double, seconds double, top_words string")


def topic_words(factors: DataFrame, k: int = 10) -> DataFrame:
    return top_per_group(factors, ["topic"], [F.desc("weight"), F.asc("term")], k).select("topic", "rank", "term", "weight")


def dominant_topic(df: DataFrame, weights: str = "weights") -> DataFrame:
    """Index (from 0, first on ties) and weight of the largest topic."""
    best = F.array_max(weights)
    return df.withColumns({"dominant_topic": (F.array_position(weights, best) - 1).cast("int"), "topic_confidence": best})


def count_vectors(df: DataFrame, terms: str, vocab: DataFrame, name: str = "features") -> DataFrame:
    """Sparse count vectors on the (bounded) vocabulary."""
    ordered = [r["term"] for r in vocab.select("term_id", "term").orderBy("term_id").collect()]
    return CountVectorizerModel.from_vocabulary(ordered, inputCol=terms, outputCol=name).transform(df)


@dataclass
class LdaModel:
    """Topics as Dirichlet parameters (topics x terms) and the two priors."""

    topics: np.ndarray
    alpha: float
    eta: float

    @property
    def k(self) -> int:
        return len(self.topics)

    def weights(self) -> np.ndarray:
        """exp E[log beta], terms x topics."""
        return np.ascontiguousarray(np.exp(digamma(self.topics) - digamma(self.topics.sum(axis=1, keepdims=True))).T)


_SHIFT = 8
CELLS = 1 << 15        # (text, term) cells in hand at a time
BLOCK_ENTRIES = 1 << 18  # of a stored block of texts
ROUND = 6              # updates of a piece, in pairs, before texts that are done make room
MOVED = 1e-3           # a text is done when its parameters move less than this on average, as in MLlib


def digamma(x: np.ndarray) -> np.ndarray:
    """For positive numbers, to some 1e-13."""
    y = x + _SHIFT
    z = 1.0 / (y * y)
    out = z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z * (1 / 240 - z * (1 / 132 - z * 691 / 32760)))))
    # 1 / x + ... + 1 / (x + 7), in pairs: (x + i) + (x + 7 - i) over their product
    double, square = 2 * x + 7, x * (x + 7)
    rest = 1 / square + 1 / (square + 6) + 1 / (square + 10) + 1 / (square + 12)
    return np.log(y) - 0.5 / y - out - double * rest


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For positive numbers."""
    y = x + _SHIFT
    z = 1.0 / (y * y)
    out = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    for i in range(_SHIFT):
        out -= np.log(x + i)
    return out


def _tiles(sizes: np.ndarray, texts: np.ndarray) -> Iterator[np.ndarray]:
    """``texts`` in pieces of similar length, shorter ones first."""
    order = texts[np.argsort(sizes[texts], kind="stable")]
    at = 0
    while at < len(order):
        many = np.arange(1, len(order) - at + 1) * sizes[order[at:]]
        upto = at + max(1, int(np.searchsorted(many, CELLS, "right")))
        yield order[at:upto]
        at = upto


def topic_mixes(sizes: np.ndarray, idx: np.ndarray, cnt: np.ndarray, weights: np.ndarray, alpha: float,
                stats: np.ndarray | None = None, fits: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Dirichlet parameters of the topic mix of every text (texts x topics) and, if wanted, the sum of n x log of its terms' weights under the mix.

    Variational inference as in online LDA (Hoffman et al.): a text is done when an update moves its parameters by less than ``MOVED``. Every
    third point is extrapolated from two updates (squared extrapolation, Varadhan and Roland), which only shortens the way. Texts begin at
    ones. Those that take long are put together after some ``ROUND`` updates. The expected counts
    are added to ``stats`` (terms x topics). Texts are given by their number of terms, and the term and count of all entries, in order.
    """
    n_topics, first, todo = weights.shape[1], np.cumsum(sizes) - sizes, np.flatnonzero(sizes)
    out = np.ones((len(sizes), n_topics))
    out[sizes == 0] = alpha
    fit, by_topic = np.zeros(len(sizes)), np.ascontiguousarray(weights.T)

    def cells(tile: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms and counts (texts x cells) and weights (texts x topics x cells), shorter texts filled up with counts of 0."""
        cell = np.arange(int(sizes[tile[-1]]))
        inside = cell < sizes[tile, None]
        at = np.where(inside, first[tile, None] + cell, 0)
        terms = idx[at]
        w = np.empty((n_topics, *terms.shape))
        for j in range(n_topics):
            np.take(by_topic[j], terms, out=w[j], mode="clip")
        return terms, np.where(inside, cnt[at], 0.0), w.transpose(1, 0, 2)

    def update(g: np.ndarray, w: np.ndarray, counts: np.ndarray) -> np.ndarray:
        theta = np.exp(digamma(g))
        share = np.matmul(theta[:, None, :], w)[:, 0, :]
        share += 1e-100
        np.divide(counts, share, out=share)
        return theta * np.matmul(w, share[:, :, None])[:, :, 0] + alpha

    def settle(tile: np.ndarray, terms: np.ndarray, counts: np.ndarray, w: np.ndarray) -> None:
        """What the texts of a tile with counts add to the sums."""
        theta = np.exp(digamma(out[tile]))
        seen = np.matmul(theta[:, None, :], w)[:, 0, :] + 1e-100
        if fits:
            fit[tile] += (counts * (np.log(seen) - digamma(out[tile].sum(axis=1))[:, None])).sum(axis=1)
        if stats is not None:
            share, terms = counts / seen, terms.ravel()
            for j in range(n_topics):
                stats[:, j] += np.bincount(terms, weights=(share * theta[:, j:j + 1]).ravel(), minlength=len(stats))

    while len(todo):
        left = []
        for tile in _tiles(sizes, todo):
            terms, all_counts, all_w = cells(tile)
            g0, here, counts, w = out[tile], np.arange(len(tile)), all_counts, all_w
            for _ in range(ROUND):
                g1 = update(g0, w, counts)
                moves = np.abs(g1 - g0).sum(axis=1) > MOVED * n_topics
                if not moves.all():
                    out[tile[here[~moves]]] = g1[~moves]
                    here, g0, g1 = here[moves], g0[moves], g1[moves]
                    if not len(here):
                        break
                    w, counts = w[moves], counts[moves]
                g2 = update(g1, w, counts)
                r, v = g1 - g0, g2 - 2 * g1 + g0
                length = np.sqrt((r * r).sum(axis=1, keepdims=True) / np.maximum((v * v).sum(axis=1, keepdims=True), 1e-300))
                step = np.where(np.isfinite(length), np.maximum(length, 1.0), 1.0)
                g0 = np.maximum(g0 + 2 * step * r + step * step * v, alpha)
            if len(here):
                out[tile[here]] = g0
                all_counts[here] = 0.0  # not yet
                left.append(tile[here])
            if stats is not None or fits:
                settle(tile, terms, all_counts, all_w)
        todo = np.sort(np.concatenate([*left, np.zeros(0, int)]))
    return out, fit


def _entries(column: pa.Array) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(width, number of terms, terms, counts) of a batch of vectors."""
    kind, size, at, values = (column.field(i) for i in range(4))
    sparse = kind.to_numpy(zero_copy_only=False) == 0
    if sparse.all():
        n = at.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        width = int(pc.max(size).as_py() or 0)
        return width, n, at.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy().astype(float)
    parts = [(np.asarray(v["indices"]), np.asarray(v["values"], float)) if v["type"] == 0 else (np.flatnonzero(v["values"]), np.asarray(v["values"], float)[np.flatnonzero(v["values"])])
             for v in column.to_pylist()]
    width = max((v["size"] if v["type"] == 0 else len(v["values"]) for v in column.to_pylist()), default=0)
    return width, np.array([len(i) for i, _ in parts], np.int64), np.concatenate([i for i, _ in parts]).astype(np.int64), np.concatenate([v for _, v in parts])


def _blocks(vectors: DataFrame) -> DataFrame:
    """(width, sizes, idx, cnt): the texts that have terms, many to a row, as bytes; blocks are dealt evenly."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width, n, idx, cnt = _entries(batch.column(0))
            idx, cnt, n = idx[cnt != 0], cnt[cnt != 0], np.bincount(np.repeat(np.arange(len(n)), n)[cnt != 0], minlength=len(n))
            n = n[n > 0]
            ends, i = np.cumsum(n), 0
            while i < len(n):
                low = ends[i] - n[i]
                j = max(i + 1, int(np.searchsorted(ends, low + BLOCK_ENTRIES, "right")))
                part = slice(low, ends[j - 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([width], pa.int32()), pa.array([n[i:j].astype(np.int32).tobytes()], pa.binary()),
                     pa.array([idx[part].astype(np.int32).tobytes()], pa.binary()), pa.array([cnt[part].tobytes()], pa.binary())], names=["width", "sizes", "idx", "cnt"])
                i = j

    packed = vectors.select("features").mapInArrow(pack, "width int, sizes binary, idx binary, cnt binary")
    parts = 2 * vectors.sparkSession.sparkContext.defaultParallelism
    return packed.repartition(parts)


def _unpacked(row: dict[str, object]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["sizes"], np.int32).astype(np.int64), np.frombuffer(row["idx"], np.int32), np.frombuffer(row["cnt"], float))


def lda_fit(vectors: DataFrame, k: int = 6, passes: int = 50, seed: int = 42, alpha: float = 0.1, eta: float = 0.01, offset: float = 50.0,
            decay: float = 0.51) -> LdaModel:
    """Online LDA with fixed priors; every iteration sees all texts, so ``passes`` is the number of passes over them.

    The updates are those of MLlib's online optimizer, with each text once per pass instead of drawn with replacement. Texts are packed
    into blocks that are kept for the passes, and each pass infers every text afresh: texts that start where the pass before left them
    stay with topics that they got by chance. Expected counts are added up by task; at most 16 tables of terms x topics reach the driver.
    """
    blocks = _blocks(vectors).persist(StorageLevel.MEMORY_AND_DISK)
    width = blocks.agg(F.max("width")).first()[0] or 0
    model = LdaModel(np.random.default_rng(seed).gamma(100.0, 0.01, (k, width)), alpha, eta)
    for step in range(passes if width else 0):
        shared = vectors.sparkSession.sparkContext.broadcast(model.weights())

        def infer(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            stats = np.zeros((width, k))
            for batch in batches:
                for row in batch.to_pylist():
                    topic_mixes(*_unpacked(row), shared.value, alpha, stats=stats)
            yield pa.RecordBatch.from_arrays([pa.array([stats.tobytes()], pa.binary())], names=["stats"])

        counts = _summed(blocks.select("sizes", "idx", "cnt").mapInArrow(infer, "stats binary"), width * k).reshape(width, k)
        rate = (offset + step + 1) ** -decay
        model = LdaModel((1 - rate) * model.topics + rate * ((counts * shared.value).T + eta), alpha, eta)
        shared.unpersist()
    blocks.unpersist()
    return model


def _summed(stats: DataFrame, n: int, lanes: int = 16) -> np.ndarray:
    """The sum of rows of ``n`` numbers (bytes): at most ``lanes`` rows reach the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(n)
        for batch in batches:
            for value in batch.column(0):
                out += np.frombuffer(value.as_buffer(), float)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["stats"])

    dealt = stats.repartition(lanes).mapInArrow(add, "stats binary")
    return sum((np.frombuffer(r["stats"], float) for r in dealt.collect()), np.zeros(n))


def _per_text(model: LdaModel, vectors: DataFrame, columns: Sequence[str], schema: str, told: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[pa.Array]]) -> DataFrame:
    """``columns`` and ``told(number of terms, counts, mixes, fits)`` for every text."""
    shared, alpha = vectors.sparkSession.sparkContext.broadcast(model.weights()), model.alpha

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, column = batch.columns
            _, n, idx, cnt = _entries(column)
            doc = np.repeat(np.arange(len(n)), n)[cnt != 0]
            n, idx, cnt = np.bincount(doc, minlength=len(n)), idx[cnt != 0], cnt[cnt != 0]
            mixes, fit = topic_mixes(n, idx, cnt, shared.value, alpha, fits=True) if len(shared.value) else (np.full((len(n), shared.value.shape[1]), alpha), np.zeros(len(n)))
            out = told(n, np.bincount(doc, weights=cnt, minlength=len(n)), mixes, fit)
            yield pa.RecordBatch.from_arrays([*kept, *out], names=names)

    names = [part.split()[0].strip("`") for part in schema.split(", ")]
    return vectors.select(*columns, "features").mapInArrow(run, schema)


def lda_topics(model: LdaModel, vectors: DataFrame, id_col: str = "email_id") -> DataFrame:
    """(id, probs): topic mix of every document; one without vocabulary terms has the symmetric prior's even mix."""
    def told(n, total, mixes, fit):
        probs = mixes / mixes.sum(axis=1, keepdims=True)
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * mixes.shape[1]), pa.array(probs.ravel()))]

    return _per_text(model, vectors, [id_col], f"`{id_col}` {dict(vectors.dtypes)[id_col]}, probs array<double>", told)


def lda_quality(model: LdaModel, vectors: DataFrame) -> DataFrame:
    """(log_likelihood, log_perplexity, perplexity): the variational bound over the texts with terms, as MLlib has it."""
    alpha, topics, width = model.alpha, model.topics, model.topics.shape[1]

    def told(n, total, mixes, fit):
        log_mix = digamma(mixes) - digamma(mixes.sum(axis=1, keepdims=True))
        prior = ((alpha - mixes) * log_mix + log_gamma(mixes)).sum(axis=1) - log_gamma(mixes.sum(axis=1)) + float(
            log_gamma(np.array(alpha * mixes.shape[1])) - mixes.shape[1] * log_gamma(np.array(alpha)))
        return [pa.array(np.where(n > 0, fit + prior, 0.0)), pa.array(total)]

    texts = _per_text(model, vectors, [], "bound double, n double", told).agg(F.sum("bound").alias("bound"), F.sum("n").alias("n")).first()
    bound, n = texts["bound"] or 0.0, texts["n"] or 0.0
    log_topics = digamma(topics) - digamma(topics.sum(axis=1, keepdims=True))
    bound += float(((model.eta - topics) * log_topics + log_gamma(topics) - log_gamma(np.array(model.eta))).sum()
                   + (log_gamma(np.array(model.eta * max(width, 1))) - log_gamma(topics.sum(axis=1))).sum()) if width else 0.0
    rate = -bound / n if n else float("nan")
    return vectors.sparkSession.createDataFrame([(bound, rate, float(np.exp(rate)))], "log_likelihood double, log_perplexity double, perplexity double")


def topic_entropy(df: DataFrame, probs: str = "probs") -> DataFrame:
    """Natural-log entropy of the topic mix (0 ln 0 = 0) and the largest share."""
    h = F.aggregate(probs, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log(p)).otherwise(F.lit(0.0)))
    return df.withColumns({"lda_entropy": h, "lda_max_prob": F.array_max(probs)})


def topic_agreement(df: DataFrame, a: str = "nmf_topic", b: str = "lda_topic") -> DataFrame:
    """Share of documents with the same topic index in both models."""
    return df.agg(F.count(F.lit(1)).alias("n_docs"), F.avg((F.col(a) == F.col(b)).cast("int")).alias("agreement"))
