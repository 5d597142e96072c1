"""Language by string kernels: which n-grams a text has in common with landmark texts.

A text becomes lower-case letters with one blank between runs of them. Its features are all n-grams of 1 to ``LONGEST`` characters
that it holds, once each. The kernel of two texts is the number of features they share over the root of the product of
their numbers of features (blended spectrum, presence). Features are those that at least two landmarks hold, the
``FEATURES`` most widespread ones.

Fit: landmarks are drawn evenly from the languages. Nyström features of a text are its kernel values with all landmarks times the
inverse root of the landmarks' own kernel matrix; ridge regression on these learns one score per language against the rest. A
temperature, set on rows that the regression did not see, turns scores into probabilities. Kernel rows of the sample are
computed by Spark tasks; only these rows (``SAMPLE`` by landmarks) and the landmark texts reach the driver.

Scoring: a batch of texts times the landmark matrix gives its kernel rows, and these times the learned matrix the scores.

The language, source and id of a text are never looked at when it is scored. Null texts and texts without a letter are ``und`` with
score 0; so is every text if nothing could be learned. A null id is not held out. Repeated rows score alike; ties between
languages go to the first by name. Texts are read whole; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import map_batches, stored
from tarn.llm.kernels import U64, chained_names

LONGEST = 4
SAMPLE = 4096
PER_LANGUAGE = 32
MOST_LANDMARKS = 512
MOST_LANGUAGES = 10_000
LANDMARK_CHARS = (300, 5000)
FEATURES = 1 << 15
RIDGE = 1e-4
UNKNOWN = "und"
_LETTERS: list[np.ndarray] = []


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def spectra(texts: list[str | None]) -> list[np.ndarray | None]:
    """Sorted distinct n-gram names of each text; None without a letter."""
    if not texts:
        return []
    low = [(t or "").lower() for t in texts]
    data = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[data]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    plain = np.where(letter, data, 32)[keep].astype(U64)
    names = [chained_names(plain, n) for n in range(1, LONGEST + 1)]
    place = np.flatnonzero(plain != U64(32))
    before = np.concatenate([[0], np.cumsum(letter)])
    ends = 1 + np.cumsum([len(t) + 1 for t in low])
    out: list[np.ndarray | None] = []
    for first, last in zip(before[np.append(1, ends[:-1])], before[ends - 1]):
        if first == last:
            out.append(None)
            continue
        a, b = place[first] - 1, place[last - 1] + 2  # with the blanks around
        out.append(np.unique(np.concatenate([x[a:max(b - n, a)] for n, x in enumerate(names)])))
    return out


@dataclass
class Landmarks:
    features: np.ndarray  # sorted names
    matrix: np.ndarray  # feature x landmark, 1 where it is present, over the root of the landmark's number of features

    @classmethod
    def of(cls, texts: list[str]) -> Landmarks:
        found = [x for x in spectra(texts) if x is not None]
        names, counts = np.unique(np.concatenate([np.zeros(0, U64), *found]), return_counts=True)
        wide = np.flatnonzero(counts >= min(2, len(found)))
        best = np.sort(wide[np.lexsort((names[wide], -counts[wide]))[:FEATURES]])
        names = names[best]
        matrix = np.stack([np.isin(names, x) for x in found], axis=1).astype(np.float32) if found else np.zeros((0, 0), np.float32)
        return cls(names, matrix / np.sqrt(np.maximum(matrix.sum(axis=0), 1)))

    def kernel(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Kernel values of each text with each landmark, and whether the text has a letter."""
        out = np.zeros((len(texts), self.matrix.shape[1]), np.float32)
        known = np.zeros(len(texts), bool)
        for i, names in enumerate(spectra(texts)):
            if names is None:
                continue
            known[i] = True
            at = np.searchsorted(self.features, names)
            at = at[self.features[np.minimum(at, len(self.features) - 1)] == names] if len(self.features) else at[:0]
            if len(at):
                out[i] = self.matrix[at].sum(axis=0) / np.sqrt(len(at))
        return out, known


def _ridge(features: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights (the last row is the bias) of the regression of -1/1 targets."""
    x = np.column_stack([features, np.ones(len(features))])
    own = x * weight[:, None]
    penalty = np.full(x.shape[1], RIDGE * weight.sum())
    penalty[-1] = 1e-9
    return np.linalg.solve(own.T @ x + np.diag(penalty), own.T @ target)


def _probabilities(scores: np.ndarray, temperature: float) -> np.ndarray:
    scaled = scores * temperature
    out = np.exp(scaled - scaled.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


@dataclass
class Model:
    landmarks: Landmarks
    languages: list[str]
    weights: np.ndarray  # landmark x language, then the bias
    temperature: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        kernel, known = self.landmarks.kernel(texts)
        chance = _probabilities(kernel @ self.weights[:-1] + self.weights[-1], self.temperature)
        best = chance.argmax(axis=1)
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)], np.where(known, chance.max(axis=1), 0.0)


def _solve(landmarks: Landmarks, kernel: np.ndarray, langs: np.ndarray) -> Model:
    languages = sorted(set(langs))
    own, turn = np.linalg.eigh(landmarks.matrix.T.astype(float) @ landmarks.matrix)
    keep = own > 1e-6 * max(own.max(initial=0), 1e-12)
    root = turn[:, keep] / np.sqrt(own[keep])
    features = kernel @ root
    hit = langs[:, None] == np.array(languages)[None, :]
    target = np.where(hit, 1.0, -1.0)
    weight = (1 / np.maximum(hit.sum(axis=0), 1))[hit.argmax(axis=1)] * len(langs) / len(languages)  # languages count alike
    fold = np.arange(len(langs)) % 2 == 0
    temperature = 4.0
    if fold.sum() > 1 and (~fold).sum() > 1 and len(languages) > 1:
        w = _ridge(features[fold], target[fold], weight[fold])
        unseen = features[~fold] @ w[:-1] + w[-1]
        tried = [0.5 * 1.25 ** i for i in range(24)]
        temperature = min(tried, key=lambda t: -np.log(np.maximum((_probabilities(unseen, t) * hit[~fold]).sum(axis=1), 1e-4)).mean())
    w = _ridge(features, target, weight)
    return Model(landmarks, languages, np.vstack([root @ w[:-1], w[-1:]]).astype(np.float32), float(temperature))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` rows that are not held out, as many from each language as there are, the first by hash of their id.

    Landmarks are taken from these, at most ``PER_LANGUAGE`` of a language and ``MOST_LANDMARKS`` in all, preferably of ``LANDMARK_CHARS`` characters.
    """
    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(~held_out()).select(F.col("lang").cast("string").alias("lang"), "text", F.length("text").alias("size"),
                                                                                       F.xxhash64(F.col("doc_id"), "text").alias("at"))
    # ids are hashed evenly, so a language's first rows lie below a bound that its count gives: only about 4 * sample rows of it are shuffled
    counts = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-counts")
    share = (F.col("at").cast("double") + 2.0 ** 63) / 2.0 ** 64 * F.col("n") < 4.0 * sample
    few = counts.limit(MOST_LANGUAGES + 1).count() <= MOST_LANGUAGES
    near = rows.join(F.broadcast(counts), "lang").filter(share).drop("n") if few else rows
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("at", "text"))
    chosen = stored(near.withColumn("turn", turn).filter(F.col("turn") <= sample).orderBy("turn", "at", "lang").limit(sample), "language-sample")
    n = chosen.agg(F.count_distinct("lang")).first()[0]
    if not n:
        return Model(Landmarks.of([]), [], np.zeros((0, 0)), 1.0)
    per = min(PER_LANGUAGE, max(MOST_LANDMARKS // n, 1))
    order = Window.partitionBy("lang").orderBy(F.desc(F.col("size").between(*LANDMARK_CHARS)), F.greatest("size", F.lit(LANDMARK_CHARS[1])), "at", "text")
    marks = chosen.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per).orderBy("place", "lang").limit(MOST_LANDMARKS)
    landmarks = Landmarks.of([r["text"] for r in marks.select("text").collect()])
    handle = docs.sparkSession.sparkContext.broadcast(landmarks)

    def kernels(batch: pa.RecordBatch):
        kernel, known = handle.value.kernel(batch.column("text").to_pylist())
        rows = [k.tobytes() if ok else None for k, ok in zip(kernel, known)]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("at"), pa.array(rows, pa.binary())], names=["lang", "at", "kernel"])

    held = map_batches(chosen.select("lang", "at", "text"), kernels, "lang string, at long, kernel binary").filter("kernel IS NOT NULL").orderBy("at", "lang").toPandas()
    if held.empty:
        return Model(Landmarks.of([]), [], np.zeros((0, 0)), 1.0)
    kernel = np.frombuffer(b"".join(held["kernel"]), np.float32).reshape(len(held), -1).astype(float)
    return _solve(landmarks, kernel, held["lang"].to_numpy())


def predicted(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row for each row of ``docs``."""
    handle = docs.sparkSession.sparkContext.broadcast(fit(docs, sample))

    def run(batch: pa.RecordBatch):
        langs, scores = handle.value.predict(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                         names=["doc_id", "held_out", "lang_pred", "score"])

    return map_batches(docs.select("doc_id", held_out().alias("held_out"), "text"), run,
                       f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")
