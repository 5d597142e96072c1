"""Terms of texts: n-grams, vocabulary, counts and TF-IDF.

A text whose id occurs once is counted inside its row, so only sums per term are shuffled; rows that share an id, or
have none, are counted as long tables grouped by id.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.functions.texts import ADDRESS, URL, clean_text
from tarn.operators.joins import lookup
from tarn.session import cut_lineage

# English words that carry no topic.
STOP_WORDS = (
    "about above after again against all also am an and any are as at be because been before being below between both "
    "but by can cannot could did do does doing down during each else ever every few for from further get had has have "
    "having he her here hers herself him himself his how however if in into is it its itself just least less may me "
    "might more most much must my myself never no nor not now of off often on once only or other our ours ourselves out "
    "over own per rather re same she should since so some still such than that the their theirs them themselves then "
    "there these they this those through thus to together too toward under until up upon us very was we well were what "
    "when where whether which while who whom why will with within without would yet you your yours yourself yourselves"
).split()
MIN_DOCS, MAX_SHARE, MAX_TERMS = 5, 0.85, 5000
SLICE_BYTES = 8 << 20  # text of a batch that is in hand at a time
_BLANK = r"[\t\n\x0B\f\r ]"  # the blanks of Java's \s


def word_list(text: str = "body") -> Column:
    """Words of two or more characters without stop words, in order."""
    return F.filter(F.split(clean_text(text), " "), lambda w: (F.length(w) >= 2) & ~w.isin(STOP_WORDS))


def split_repeated(df: DataFrame, id_col: str = "email_id") -> tuple[DataFrame, DataFrame | None]:
    """The rows whose id occurs once, and all other rows (repeated ids and null) or None if there are none."""
    often = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | F.col(id_col).isNull())
    often = cut_lineage(often.select(id_col, F.lit(1).alias("_again")))
    if often.isEmpty():
        return df, None
    marked = lookup(df, often, [id_col])
    again = F.col(id_col).isNull() | F.coalesce(F.col("_again") == 1, F.lit(False))
    return marked.filter(~again).drop("_again"), marked.filter(again).drop("_again")


def runs(words: str, n: int = 2) -> Column:
    """All runs of 1 to n neighbouring words of a word list, shorter ones first."""
    out = grown = F.col(words)
    for size in range(2, n + 1):
        left = F.slice(grown, F.lit(1), F.greatest(F.size(words) - (size - 1), F.lit(0)))
        right = F.slice(F.col(words), F.lit(size), F.greatest(F.size(words) - (size - 1), F.lit(0)))
        grown = F.zip_with(left, right, lambda a, b: F.concat(a, F.lit(" "), b))
        out = F.concat(out, grown)
    return out


def term_lists_of(df: DataFrame, id_col: str = "email_id", text: str = "body", n: int = 2) -> DataFrame:
    """(id, terms): every occurrence of every run of 1 to n words left after stop-word removal, one row per text."""
    return df.select(id_col, word_list(text).alias("_words")).select(id_col, runs("_words", n).alias("terms"))


def tokens(df: DataFrame, id_col: str = "email_id", text: str = "body", n: int = 2) -> DataFrame:
    """(id, term), one row per occurrence of every run of 1 to n words left after stop-word removal.

    Runs are zipped from the row's own word list, so nothing is shuffled before terms are counted.
    """
    return term_lists_of(df, id_col, text, n).select(id_col, F.explode("terms").alias("term"))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``word_list`` for a batch of texts inside a task: all words in order, and the number of words of each text."""
    try:
        out = pc.utf8_lower(pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), "\u0130", "i\u0307"))
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        clean = [b.decode("utf-8", "replace") for b in pc.fill_null(texts, "").cast(pa.binary()).to_pylist()]
        out = pc.utf8_lower(pc.replace_substring(pa.array(clean, pa.large_string()), "\u0130", "i\u0307"))
    for pattern in (URL, ADDRESS, r"[^a-z0-9\s]"):
        out = pc.replace_substring_regex(out, pattern.replace(r"\S", _BLANK.replace("[", "[^")).replace(r"\s", _BLANK[1:-1]), " ")
    lists = pc.split_pattern(pc.replace_substring_regex(out, _BLANK + "+", " "), " ")
    words = lists.flatten()
    keep = pc.and_(pc.greater_equal(pc.binary_length(words), 2), pc.invert(pc.is_in(words, value_set=pa.array(STOP_WORDS, words.type))))
    held = np.concatenate(([0], np.cumsum(keep.to_numpy(zero_copy_only=False))))
    ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
    return words.filter(keep), np.diff(held[ends])


def _word_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, pa.Array, np.ndarray]]:
    """(ids, number of words of each text, all words, text number of each word) of pieces of the batches (id, text)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        while at < len(sizes):
            upto = max(at + 1, at + int(np.searchsorted(np.cumsum(sizes[at:]), SLICE_BYTES, "right")))
            part = batch.slice(at, upto - at)
            words, n = words_of(part.column(1))
            yield part.column(0), n, words, np.repeat(np.arange(upto - at), n)
            at = upto


def _runs(words: pa.Array, doc: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray]:
    """All runs of 1 to n words and the number of their text."""
    terms, docs = [words], [doc]
    grown = words
    for size in range(2, n + 1):
        if len(words) < size:
            break
        grown = pc.binary_join_element_wise(grown.slice(0, len(words) - size + 1), words.slice(size - 1), pa.scalar(" ", words.type))
        inside = doc[:len(doc) - size + 1] == doc[size - 1:]
        terms.append(grown.filter(pa.array(inside)))
        docs.append(doc[:len(doc) - size + 1][inside])
    return pa.concat_arrays(terms), np.concatenate(docs)


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs."""
    key = np.sort(key)
    first = np.flatnonzero(np.r_[np.ones(min(1, len(key)), bool), key[1:] != key[:-1]])
    return key[first], np.diff(np.r_[first, len(key)])


def _ends(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))


def _texts(df: DataFrame, id_col: str, text: str) -> DataFrame:
    return df.select(id_col, F.col(text).alias("_text"))


def word_rows(df: DataFrame, id_col: str = "email_id", text: str = "body") -> DataFrame:
    """(id, words): ``word_list`` of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sizes, words, _ in _word_slices(batches):
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(_ends(sizes), words.cast(pa.string()))], names=[id_col, "words"])

    return _texts(df, id_col, text).mapInArrow(run, f"{id_col} {dict(df.dtypes)[id_col]}, words array<string>")


def term_figures(df: DataFrame, id_col: str = "email_id", text: str = "body", n: int = 2) -> DataFrame:
    """(id, n_terms, n_distinct, first_term, last_term) of every id that has a term."""
    once, again = split_repeated(df, id_col)

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sizes, words, doc in _word_slices(batches):
            terms, docs = _runs(words, doc, n)
            coded = terms.dictionary_encode()
            order = pc.sort_indices(coded.dictionary).to_numpy()  # ASCII words, so by bytes
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            width = max(1, len(order))
            key, _ = _counted(docs * width + place[coded.indices.to_numpy()])
            of, at = key // width, np.flatnonzero(sizes > 0)
            lo, hi = np.searchsorted(of, at), np.searchsorted(of, at, "right")
            named = coded.dictionary.cast(pa.string())
            total = np.bincount(docs, minlength=len(sizes))[at]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at)), pa.array(total.astype(np.int64)), pa.array((hi - lo).astype(np.int64)),
                 *[named.take(pa.array(order[key[x] % width])) for x in (lo, hi - 1)]], names=[id_col, "n_terms", "n_distinct", "first_term", "last_term"])

    out = _texts(once, id_col, text).mapInArrow(
        figures, f"{id_col} {dict(df.dtypes)[id_col]}, n_terms long, n_distinct long, first_term string, last_term string")
    if again is None:
        return out
    return out.unionByName(tokens(again, id_col, text, n).groupBy(id_col).agg(
        F.count(F.lit(1)).alias("n_terms"), F.countDistinct("term").alias("n_distinct"), F.min("term").alias("first_term"), F.max("term").alias("last_term")))


def term_sums(df: DataFrame, id_col: str = "email_id", text: str = "body", n: int = 2) -> DataFrame:
    """(term, df, total) of texts whose ids occur once: texts that hold the term, and its occurrences.

    Terms are counted inside a batch of texts; only the sums of batches are shuffled.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, words, doc in _word_slices(batches):
            terms, docs = _runs(words, doc, n)
            coded = terms.dictionary_encode()
            code, many = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
            held, _ = _counted(docs * max(1, many) + code)
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.cast(pa.string()), *[pa.array(np.bincount(x, minlength=many).astype(np.int64)) for x in (held % max(1, many), code)]],
                names=["term", "df", "total"])

    return _texts(df, id_col, text).mapInArrow(count, "term string, df long, total long").groupBy("term").agg(
        F.sum("df").alias("df"), F.sum("total").alias("total"))


def _vocabulary_counts(batches: Iterator[pa.RecordBatch], terms: Sequence[str], n: int):
    """(ids, text number, term number, count) of pieces of the batches, in order, for the terms of the vocabulary."""
    for ids, _, words, doc in _word_slices(batches):
        found, docs = _runs(words, doc, n)
        number = pc.fill_null(pc.index_in(found, value_set=pa.array(terms, found.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        key, tf = _counted(docs[number >= 0] * max(1, len(terms)) + number[number >= 0])
        yield ids, key // max(1, len(terms)), key % max(1, len(terms)), tf


def vocabulary_rows(df: DataFrame, terms: Sequence[str], idf: Sequence[float], id_col: str = "email_id", text: str = "body", n: int = 2) -> DataFrame:
    """(id, idx, tf, val), one row per text whose id occurs once: numbers of its vocabulary terms in order, their counts, and
    tf x idf scaled to length 1. ``terms`` is the (bounded) vocabulary in the order of its numbers."""
    shared = df.sparkSession.sparkContext.broadcast((list(terms), np.asarray(idf, dtype=float)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight = shared.value
        for ids, of, idx, tf in _vocabulary_counts(batches, known, n):
            raw = tf * weight[idx]
            val = raw / np.sqrt(np.bincount(of, weights=raw * raw, minlength=len(ids)))[of]
            ends = _ends(np.bincount(of, minlength=len(ids)))
            yield pa.RecordBatch.from_arrays(
                [ids, *[pa.ListArray.from_arrays(ends, pa.array(v)) for v in (idx.astype(np.int32), tf.astype(np.int64), val)]], names=[id_col, "idx", "tf", "val"])

    return _texts(df, id_col, text).mapInArrow(count, f"{id_col} {dict(df.dtypes)[id_col]}, idx array<int>, tf array<long>, val array<double>")


def vocabulary_lists(df: DataFrame, terms: Sequence[str], id_col: str = "email_id", text: str = "body", n: int = 2) -> DataFrame:
    """(id, terms), one row per text whose id occurs once: every vocabulary term as often as it occurs, for the MLlib vectorizer."""
    shared = df.sparkSession.sparkContext.broadcast(list(terms))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.string())
        for ids, of, idx, tf in _vocabulary_counts(batches, shared.value, n):
            ends = _ends(np.bincount(of, weights=tf, minlength=len(ids)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(ends, known.take(pa.array(np.repeat(idx, tf))))], names=[id_col, "terms"])

    return _texts(df, id_col, text).mapInArrow(count, f"{id_col} {dict(df.dtypes)[id_col]}, terms array<string>")


def term_counts(tok: DataFrame, id_col: str = "email_id") -> DataFrame:
    return tok.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(counts: DataFrame, n_docs: int | Column, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
               max_terms: int = MAX_TERMS) -> DataFrame:
    """(term_id, term, df, total): the most frequent terms that are neither rare nor everywhere. At most ``max_terms`` rows."""
    return best_terms(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")), n_docs, min_docs, max_share, max_terms)


def best_terms(stats: DataFrame, n_docs: int | Column, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
               max_terms: int = MAX_TERMS) -> DataFrame:
    """``vocabulary`` from (term, df, total)."""
    kept = stats.filter((F.col("df") >= min_docs) & (F.col("df") <= F.lit(max_share) * n_docs))
    best = kept.orderBy(F.desc("total"), "term").limit(max_terms)
    return best.withColumn("term_id", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("term")) - 1)


def count_matrix(counts: DataFrame, vocab: DataFrame, id_col: str = "email_id") -> DataFrame:
    """(id, term_id, term, tf) on the vocabulary; the vocabulary is bounded, so it is broadcast."""
    small = F.broadcast(vocab.select("term", "term_id", "df"))
    return counts.join(small, "term").select(id_col, "term_id", "term", "tf", "df")


def tfidf(matrix: DataFrame, n_docs: int | Column, id_col: str = "email_id") -> DataFrame:
    """tf x (ln((1+n)/(1+df)) + 1), scaled to length 1 per document."""
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0
    raw = matrix.withColumn("_w", F.col("tf") * idf)
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return raw.withColumn("tfidf", F.col("_w") / norm).select(id_col, "term_id", "term", "tf", "tfidf")


def idf_weights(vocab: DataFrame, n_docs: int) -> list[float]:
    """ln((1+n)/(1+df)) + 1 of every vocabulary term, in term order (at most ``max_terms`` numbers)."""
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0
    return [r["idf"] for r in vocab.select("term_id", idf.alias("idf")).orderBy("term_id").collect()]


def matrix_shape(matrix: DataFrame, n_docs: int | Column, vocab: DataFrame) -> DataFrame:
    terms = vocab.agg(F.count(F.lit(1)).alias("n")).scalar()
    out = matrix.agg(F.count(F.lit(1)).alias("non_zero")).select(F.lit(n_docs).cast("long").alias("n_docs"), terms.alias("n_terms"), "non_zero")
    return out.withColumn("sparsity", 1 - F.try_divide(F.col("non_zero"), F.col("n_docs") * F.col("n_terms")))


def top_terms(weights: DataFrame, n_docs: int | Column, k: int = 30) -> DataFrame:
    """Terms by mean weight over all documents, absent ones counting 0."""
    mean = weights.groupBy("term").agg((F.sum("tfidf") / n_docs).alias("mean_tfidf"))
    return mean.orderBy(F.desc("mean_tfidf"), "term").limit(k)


def every_document(rows: DataFrame, docs: DataFrame, id_col: str = "email_id") -> DataFrame:
    """``rows`` plus an empty row for each document without vocabulary terms."""
    lists = {f.name: F.coalesce(f.name, F.array().cast(f.dataType)).alias(f.name) for f in rows.schema.fields if f.name != id_col}
    return docs.select(id_col).join(rows, id_col, "left").select(id_col, *lists.values())


def document_rows(weights: DataFrame, id_col: str = "email_id", value: str = "tfidf") -> DataFrame:
    """(id, idx, val): one sparse row per document, at most one entry per vocabulary term."""
    pairs = weights.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("term_id", F.col(value).cast("double").alias("v")))).alias("p"))
    return pairs.select(id_col, F.col("p.term_id").alias("idx"), F.col("p.v").alias("val"))


def term_lists(matrix: DataFrame, id_col: str = "email_id") -> DataFrame:
    """(id, terms): every vocabulary term as often as it occurs, for the MLlib vectorizer."""
    return matrix.groupBy(id_col).agg(F.flatten(F.collect_list(F.array_repeat("term", F.col("tf").cast("int")))).alias("terms"))


def stop_word_sql() -> str:
    return ", ".join(f"'{w}'" for w in STOP_WORDS)
