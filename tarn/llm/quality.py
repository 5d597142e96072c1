"""Quality rules: text statistics and a learned decision list of threshold conjunctions.

The list is grown by sequential covering on labelled statistics: a rule takes the thresholds with the best information
gain until it covers no good document, loses the thresholds that don't help on rows set aside, and is kept if it stays precise
there; covered rows leave and the next rule starts. The result is an ordered Spark conditional expression.

The rules are fitted on at most ``SAMPLE`` labelled rows (the first by the hash of their doc_id), whatever the corpus size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.llm.common import let_go, passing_columns, slices
from tarn.llm.kernels import PIECE, SPACES, U64, batches_of, chained_names, join_texts, mix, prefix_names, substring_names, word_bounds
from tarn.session import small_batches

SAMPLE = 20_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
STATS = "_quality_stats"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct_words"]
#: what thresholds are put on: name and its Spark expression over the counts
FEATURES = {
    "n_words": "n_words", "word_length": "word_chars / n_words", "symbol_share": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines", "repeat_share": "n_repeat_words / n_words", "words_per_line": "n_words / n_lines",
    "upper_share": "n_upper / word_chars", "digit_share": "n_digits / word_chars", "mark_share": "n_marks / n_words",
    "distinct_share": "n_distinct_words / n_words",
}
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))
_MARK = np.isin(np.arange(256), list(b"!?;:"))
_LEAD = (np.arange(256) & 0xC0) != 0x80
_LINE = np.arange(256) == 10


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(names: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each name: does its text hold it more than once, and is this its first place there."""
    own = mix(names ^ (text.astype(U64) * U64(0x9E3779B97F4A7C15)))
    _, first, number, times = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    is_first = np.zeros(len(names), bool)
    is_first[first] = True
    return times[number] > 1, is_first


def text_counts(bodies: list[bytes | None]) -> np.ndarray:
    """One row of COUNTS for each text."""
    rows = [np.zeros((0, len(COUNTS)), np.int64)]
    for part in batches_of([len(b or b"") for b in bodies], PIECE):
        data, offsets = join_texts(bodies[part])
        n = len(offsets) - 1
        starts, ends = word_bounds(data, SPACES)
        prefix = prefix_names(data)
        names = substring_names(prefix, starts, ends)
        first = np.searchsorted(starts, offsets)
        text = np.repeat(np.arange(n), np.diff(first))
        low, high = word_bounds(data, _LINE)
        with_word = np.searchsorted(starts, high) > np.searchsorted(starts, low)
        low, high = low[with_word], high[with_word]
        line_text = np.searchsorted(offsets, low, "right") - 1
        _, first_line = _repeats(substring_names(prefix, low, high), line_text)
        _, first_word = _repeats(names, text)
        covered = np.zeros(len(names) + 1, np.int64)
        three = chained_names(names, 3)
        if len(three):
            inside = text[:-2] == text[2:]
            at = np.flatnonzero(inside)
            again, _ = _repeats(three[inside], text[at])
            np.add.at(covered, at[again], 1)
            np.add.at(covered, np.minimum(at[again] + 3, len(names)), -1)
        repeated = np.cumsum(covered[:-1]) > 0
        rows.append(np.stack([
            np.diff(first), _per_text(_LEAD[data] & ~SPACES[data], offsets), _per_text(_SYMBOL[data], offsets),
            np.bincount(line_text[~first_line], minlength=n), np.bincount(text[repeated], minlength=n), np.bincount(line_text, minlength=n),
            _per_text(_UPPER[data], offsets), _per_text(_DIGIT[data], offsets), _per_text(_MARK[data], offsets),
            np.bincount(text[first_word], minlength=n)], axis=1))
    return np.concatenate(rows)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` and a struct of COUNTS named STATS, which takes the place of a column of that name; a null text counts as empty."""
    docs = docs.drop(STATS)
    names = [f"c{i}" for i in range(len(docs.columns))]  # no name can clash, or needs quoting
    body = [c.lower() for c in docs.columns].index(text.lower())

    def run(batches):
        let_go()
        for batch in (piece for whole in batches for piece in slices(whole)):
            counts = text_counts(batch.column(body).cast(pa.binary()).to_pylist())
            stats = pa.StructArray.from_arrays([pa.array(counts[:, i]) for i in range(len(COUNTS))], names=COUNTS)
            yield pa.RecordBatch.from_arrays([*batch.columns, stats], names=[*names, STATS])
        pa.default_memory_pool().release_unused()

    small_batches(docs.sparkSession)
    kinds = [T.StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields)]
    schema = T.StructType([*kinds, T.StructField(STATS, T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))])
    return docs.toDF(*names).mapInArrow(run, schema).toDF(*docs.columns, STATS)


def feature(name: str) -> Column:
    """A feature as a Spark expression over STATS; a share of nothing is 0."""
    top, _, bottom = FEATURES[name].partition(" / ")
    value = F.col(f"{STATS}.{top}").cast("double")
    return F.coalesce(value / F.nullif(F.col(f"{STATS}.{bottom}"), F.lit(0)), F.lit(0.0)) if bottom else value


def feature_matrix(counts: dict[str, np.ndarray]) -> np.ndarray:
    out = []
    for expr in FEATURES.values():
        top, _, bottom = expr.partition(" / ")
        value = counts[top].astype(float)
        out.append(np.divide(value, counts[bottom], out=np.zeros(len(value)), where=counts[bottom] > 0) if bottom else value)
    return np.stack(out, axis=1)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        column = x[:, list(FEATURES).index(self.feature)]
        return column > self.threshold if self.above else column <= self.threshold

    def column(self) -> Column:
        value = feature(self.feature)
        return value > self.threshold if self.above else value <= self.threshold


@dataclass
class DecisionList:
    """Ordered conjunctions; a document that meets one is rejected, the rest are kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def keep(self) -> Column:
        chain = None
        for rule in self.rules:
            met = rule[0].column()
            for c in rule[1:]:
                met = met & c.column()
            chain = F.when(met, F.lit(False)) if chain is None else chain.when(met, F.lit(False))
        return F.lit(True) if chain is None else chain.otherwise(F.lit(True))

    def rejects(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        for rule in self.rules:
            out |= np.logical_and.reduce([c.holds(x) for c in rule])
        return out


def _best_condition(x: np.ndarray, bad: np.ndarray) -> tuple[float, Condition | None]:
    """The threshold with the greatest gain: bad rows covered, times the drop in bits needed to tell that a covered row is bad."""
    p0, n0 = bad.sum(), len(bad) - bad.sum()
    before = np.log2(p0 / (p0 + n0))
    best, found = 1e-9, None
    for k, name in enumerate(FEATURES):
        order = np.argsort(x[:, k], kind="stable")
        value, hit = x[order, k], bad[order]
        cut = np.flatnonzero(value[1:] > value[:-1])
        if not len(cut):
            continue
        below = np.cumsum(hit)[cut]
        rows = cut + 1
        middle = (value[cut] + value[cut + 1]) / 2
        for above, p, n in ((False, below, rows - below), (True, p0 - below, len(bad) - rows - (p0 - below))):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - before), 0)
            i = int(gain.argmax())
            if gain[i] > best:
                best, found = float(gain[i]), Condition(name, above, float(middle[i]))
    return best, found


def learn(x: np.ndarray, bad: np.ndarray, precision: float = 0.9, least: int = 3, seed: int = 7) -> DecisionList:
    """Sequential covering; ``least`` bad rows must be covered by a rule, and ``precision`` of the covered rows must be bad."""
    rng = np.random.default_rng(seed)
    out = DecisionList()
    left = np.ones(len(x), bool)
    while bad[left].sum() >= 2 * least:
        rows = rng.permutation(np.flatnonzero(left))
        grow, prune = rows[: 2 * len(rows) // 3], rows[2 * len(rows) // 3:]
        rule: list[Condition] = []
        inside = grow
        while bad[inside].any() and not bad[inside].all() and len(rule) < len(FEATURES):
            _, condition = _best_condition(x[inside], bad[inside])
            if condition is None:
                break
            rule.append(condition)
            inside = inside[condition.holds(x[inside])]
        if not rule:
            break

        def covered(conditions: list[Condition], of: np.ndarray) -> np.ndarray:
            return of[np.logical_and.reduce([c.holds(x[of]) for c in conditions])]

        def worth(conditions: list[Condition]) -> float:
            hit = bad[covered(conditions, prune)]
            return (2 * hit.sum() - len(hit)) / (len(hit) + 1)

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule.pop()
        hit = bad[covered(rule, rows)]
        if hit.sum() < least or hit.mean() < precision:
            break
        out.rules.append(rule)
        left[covered(rule, rows)] = False
    return out


def base_failed() -> Column:
    words, repeats = F.col(f"{STATS}.n_words"), F.col(f"{STATS}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DecisionList:
    """Rules from the first ``sample`` labelled documents by hash; rows whose doc_id, label or text is null are no examples."""
    chosen = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = docs.filter("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = with_counts(texts).filter(~base_failed()).select("doc_id", "quality", f"{STATS}.*").orderBy("doc_id", *COUNTS).toPandas()
    if rows.empty:
        return DecisionList()
    return learn(feature_matrix({c: rows[c].to_numpy() for c in COUNTS}), rows["quality"].to_numpy() == 0)


def judged(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with STATS, ``_base_failed`` and ``_kept``.

    A null or empty text has no words and fails the base rule. Without labelled rows only the base rule decides.
    Repeated rows are judged alike; all other columns pass through unchanged, those named like the three results are replaced.
    """
    rules = fit(docs, labels, sample)
    failed = base_failed()
    return with_counts(docs).withColumn("_base_failed", failed).withColumn("_kept", ~failed & rules.keep())


@passing_columns("doc_id", "text")
def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that pass the base rule and the decision list, with all their columns, whatever their names."""
    return judged(docs, labels, sample).filter("_kept").select(*docs.columns)
