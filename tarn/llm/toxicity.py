"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier trained on its posteriors.

1. Voters are lexicon words (a fixed list), words and word beginnings mined from labelled training rows, text patterns, and
   the label itself as one more imperfect voter.
2. The label model has a hidden class; each voter fires with a chance that depends on the class. Expectation
   maximisation estimates the chances. Voters that still agree within a class are correlated; each
   counts by 1 / (1 + sum of its positive correlations), and the model is fitted again with these weights.
3. A logistic regression over words, word beginnings and patterns learns the posterior labels. It scores every text.

Everything learned comes from at most ``SAMPLE`` labelled rows that are not held out (the first by hash of their doc_id).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import map_batches, stored

SAMPLE = 20_000
FEATURES = 4096
VOTERS = 256
BEGINNINGS = (4, 5, 6, 7)
LEAST_GAIN = 6.0
THRESHOLD = 0.3
#: insults and abuse, English
LEXICON = ("idiot moron stupid dumb fool loser clown scum trash garbage worthless pathetic disgusting filthy ugly vile "
           "hate kill die shut freak creep jerk imbecile coward liar vermin parasite degenerate nasty sick").split()
PATTERNS = ("?shout", "?marks", "?you_are", "?symbols")
_BLANK = bytes(32 if b < 128 and not 97 <= b <= 122 else b for b in range(256))


def text_features(text: str | None) -> set[bytes]:
    """Distinct lower-cased words, their beginnings (ending in *), and the patterns that a text shows."""
    if not text:
        return set()
    low = text.lower()
    words = set(low.encode("utf-8", "ignore").translate(_BLANK).split())
    out = set(words)
    for n in BEGINNINGS:
        out.update([w[:n] + b"*" for w in words if len(w) > n])
    letters = sum(map(text.count, "ETAOIN"))
    if len(text) > 40 and letters > 3 * sum(map(text.count, "etaoin")):
        out.add(b"?shout")
    if text.count("!") > 3 + len(text) // 200:
        out.add(b"?marks")
    if b"you" in words and b"are" in words and ("you are" in low):
        out.add(b"?you_are")
    if sum(map(text.count, "*#$%&")) > len(text) // 40 + 3:
        out.add(b"?symbols")
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class LabelModel:
    prior: float
    chances: np.ndarray  # voter x class: chance to fire
    weights: np.ndarray
    correlations: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = np.log(self.prior / (1 - self.prior))
        on = np.log(self.chances[:, 1] / self.chances[:, 0])
        off = np.log((1 - self.chances[:, 1]) / (1 - self.chances[:, 0]))
        return 1 / (1 + np.exp(-np.clip(odds + votes @ (self.weights * on) + (1 - votes) @ (self.weights * off), -50, 50)))


def fit_label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 60, refits: int = 2) -> LabelModel:
    """Expectation maximisation over 0/1 ``votes`` (row x voter) from first posteriors ``start``."""
    n, k = votes.shape
    weights = np.ones(k)
    total = np.maximum(votes.sum(axis=0), 1)
    p = np.clip(start.astype(float), 0.02, 0.98)
    model = None
    for refit in range(refits + 1):
        for _ in range(rounds):
            toxic, clean = p.sum(), n - p.sum()
            fired = votes.T @ p
            chances = np.stack([(total - fired + 0.05) / (clean + 1), (fired + 0.05) / (toxic + 1)], axis=1)
            model = LabelModel(float(np.clip(toxic / n, 1e-4, 0.5)), np.clip(chances, 1e-5, 1 - 1e-5), weights, np.zeros((k, k)))
            new = model.posterior(votes)
            done = np.abs(new - p).max() < 1e-5
            p = new
            if done:
                break
        rest = votes - np.where(p[:, None] > 0.5, model.chances[None, :, 1], model.chances[None, :, 0]).astype(np.float32)
        spread = np.sqrt((rest ** 2).mean(axis=0)) + 1e-9
        correlations = rest.T @ rest / n / np.outer(spread, spread)
        np.fill_diagonal(correlations, 0)
        model.correlations = correlations
        if refit < refits:
            weights = 1 / (1 + np.clip(np.where(correlations > 0.1, correlations, 0), 0, 1).sum(axis=1))
    return model


def fit_linear(rows: np.ndarray, cols: np.ndarray, n: int, k: int, target: np.ndarray, penalty: float = 2.0, steps: int = 400) -> np.ndarray:
    """Logistic regression on sparse 0/1 features and soft labels by accelerated gradient steps; the last weight is the bias."""
    w = z = np.zeros(k + 1)
    w[-1] = np.log((target.mean() + 1e-4) / (1 - target.mean() + 1e-4))
    z = w.copy()
    curve = 0.25 * (np.bincount(cols, minlength=k) * np.sqrt(np.bincount(rows, minlength=n).max(initial=1)) + penalty)
    curve = np.append(np.maximum(curve, penalty), 0.25 * n * 2)
    for t in range(1, steps + 1):
        score = np.bincount(rows, z[cols], minlength=n) + z[-1]
        error = 1 / (1 + np.exp(-np.clip(score, -40, 40))) - target
        slope = np.append(np.bincount(cols, error[rows], minlength=k) + penalty * 0.05 * z[:-1], error.sum())
        step = z - slope / curve
        z = step + (t / (t + 3)) * (step - w)
        w = step
    return w


@dataclass
class Scorer:
    weights: dict[bytes, float]
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        get = self.weights
        known = get.keys()
        raw = np.array([sum(get[f] for f in text_features(t) & known) for t in texts], float) + self.bias
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def _counts(batch: pa.RecordBatch):
    """In how many toxic and in how many clean texts of a batch each feature is found."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
        counts[toxic == 0].update(text_features(text))
    names = list(counts[0] | counts[1])
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), *[pa.array([c[f] for f in names], pa.int64()) for c in counts]], names=["feature", "p", "n"])


def candidates(rows: DataFrame, base: float) -> DataFrame:
    """(feature, p, n, gain): the best ``FEATURES`` by gain among all that are found in at least two toxic texts.

    The counts of toxic (p) and clean (n) texts meet in Spark, so no feature is left out before its gain is known.
    """
    found = map_batches(rows.select("text", "toxic"), _counts, "feature binary, p long, n long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    share = F.col("p") / (F.col("p") + F.col("n"))
    clean = F.when(F.col("n") > 0, F.col("n") * F.log(F.greatest(1 - share, F.lit(1e-9)) / (1 - base))).otherwise(0.0)
    gain = F.when(share > base, F.col("p") * F.log(share / base) + clean).otherwise(0.0)
    return found.filter("p >= 2").withColumn("gain", gain).filter(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), F.desc("feature")).limit(FEATURES)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Learn from labelled rows that are not held out; labels other than 0 and 1, null ids and null texts are no examples."""
    chosen = (labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = stored(docs.filter("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "labelled")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    base = float(np.clip((size["toxic"] or 0) / max(size["n"], 1), 1e-3, 0.5))

    sc = docs.sparkSession.sparkContext
    best = candidates(rows, base).collect()
    names = [bytes(r["feature"]) for r in best]
    mined = [f for f, r in zip(names, best) if r["p"] >= 4 * r["n"]][:VOTERS]
    fixed = [x.encode() for x in [*LEXICON, *PATTERNS]]
    names = list(dict.fromkeys([*names, *fixed]))
    index = {f: i for i, f in enumerate(names)}
    handle = sc.broadcast(index)

    def incidence(batch: pa.RecordBatch):
        places = handle.value
        found = [sorted(places[f] for f in text_features(t) & places.keys()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic").cast(pa.int32()), pa.array(found, pa.list_(pa.int32()))],
                                         names=["doc_id", "toxic", "features"])

    held = map_batches(rows, incidence, f"doc_id {dict(docs.dtypes)['doc_id']}, toxic int, features array<int>").orderBy("doc_id", "features").toPandas()
    y = held["toxic"].to_numpy()
    if not len(y):
        return Scorer({}, float(np.log(base / (1 - base))))
    r = np.repeat(np.arange(len(y)), [len(f) for f in held["features"]])
    c = np.concatenate([np.asarray(f, np.int64) for f in held["features"]]).astype(np.int64)
    voters = [index[f] for f in dict.fromkeys([*mined, *fixed])]
    column = np.full(len(names), -1)
    column[voters] = np.arange(len(voters))
    votes = np.zeros((len(y), len(voters) + 1), np.float32)
    own = column[c] >= 0
    votes[r[own], column[c[own]]] = 1
    votes[:, -1] = y
    used = votes.sum(axis=0) > 0
    posterior = fit_label_model(votes[:, used], y).posterior(votes[:, used]) if used.any() else y.astype(float)
    w = fit_linear(r, c, len(y), len(names), posterior)
    return Scorer({f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-4}, float(w[-1]))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``.

    Only the text decides the score; an empty or null text gets the score of a text without any known feature. A
    null doc_id is not held out. Without labelled rows every text gets the same low score. Repeated rows score
    alike; other columns are ignored.
    """
    scorer = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))

    def run(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scorer.value.score(batch.column("text").to_pylist()))],
                                         names=["doc_id", "held_out", "score"])

    out = map_batches(docs.select("doc_id", held_out().alias("held_out"), "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
