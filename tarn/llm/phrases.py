"""Phrase collocations from Rabin-Karp fingerprints.

1. Tasks bring a batch of texts into one byte array with single blanks between words and line feeds between pieces, and read the
   fingerprint of every n-gram from one prefix polynomial. A task adds up equal fingerprints and sends sorted runs of
   fingerprints and counts, cut into buckets by their leading bits; Spark shuffles the buckets and sums them.
2. First words and pairs are counted, then triples and quadruples all of whose pairs are frequent. What is frequent goes back to the
   tasks as a bitmap of at most ``MOST_BITS`` bits. False positives only mean more work: nothing is decided by a fingerprint.
3. A last scan takes the occurrences of frequent fingerprints. Each is compared byte by byte with its neighbour of the
   same fingerprint; where two differ, the batch counts these n-grams by their text. Only then are phrases written out, one text per
   batch with its count and a pointer to its first occurrence, and summed by text.

So counts are exact even if fingerprints collide, and texts of rare n-grams are never materialised. Phrases, cuts and containing
phrases are joined and ranked as tables.

A null text is empty, a null language is ``und``. Repeated rows count each time. An empty table gives no phrases. Texts and words of
any length are taken whole. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import map_batches, slices, stored
from tarn.llm.kernels import U64, join_texts, mix, prefix_names, substring_names, word_bounds

LONGEST = 4
LEAST = 30
TOP = 2000
SCALE = 2_000_000
COVER = 80
MOST_BITS = 1 << 28
BUCKET_BYTES = 4 << 20
HELD_ENTRIES = 2 << 20
_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_TO_PLAIN = bytes(10 if b in _BREAKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_GAPS = np.zeros(256, bool)
_GAPS[[10, 32]] = True


class Grams:
    """Words of a batch of texts in normal form, and the fingerprints of their n-grams."""

    def __init__(self, batch: pa.RecordBatch):
        texts = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t for t in batch.column("text").to_pylist()]
        data, offsets = join_texts([t.translate(_TO_PLAIN) if t else t for t in texts])
        starts, ends = word_bounds(data, _GAPS)
        keep = ~_GAPS[data]
        keep[ends] = True  # one byte of each gap
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        following = np.append(starts[1:], len(data))
        data = data.copy()
        data[ends] = np.where(breaks[following] > breaks[ends], 10, 32)
        moved = np.concatenate([[0], np.cumsum(keep)])
        self.data = data[keep]
        self.starts, self.ends = moved[starts], moved[ends]
        self.open = self.data[self.ends] == 32  # the next word belongs to the same piece
        langs = batch.column("lang").to_pylist()
        self.langs = list(dict.fromkeys(langs))
        codes = {x: i for i, x in enumerate(self.langs)}
        self.lang = np.array([codes[x] for x in langs], np.int64)[np.searchsorted(offsets, starts, "right") - 1]
        names = [np.frombuffer(x.encode(), np.uint8) for x in self.langs]
        salts = np.array([substring_names(prefix_names(x), np.array([0]), np.array([len(x)]))[0] for x in names], U64)
        self.salt = mix(salts)[self.lang] if len(salts) else np.zeros(0, U64)
        self.prefix = prefix_names(self.data)

    def places(self, n: int) -> np.ndarray:
        """First words of all n-grams that lie in one piece."""
        ok = np.ones(max(len(self.starts) - n + 1, 0), bool)
        for i in range(n - 1):
            ok &= self.open[i:i + len(ok)]
        return np.flatnonzero(ok)

    def names(self, at: np.ndarray, n: int) -> np.ndarray:
        return mix(substring_names(self.prefix, self.starts[at], self.ends[at + n - 1]) ^ self.salt[at])


def seen(bitmap: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which names have their bit in the bitmap; its size is a power of two."""
    at = names >> U64(64 - (8 * len(bitmap)).bit_length() + 1)
    return (bitmap[at >> U64(3)] >> (at & U64(7)).astype(np.uint8)) & 1 > 0


def with_frequent_pairs(grams: Grams, pairs: np.ndarray, n: int) -> np.ndarray:
    """First words of n-grams all of whose pairs may be frequent."""
    good = np.zeros(len(grams.starts) + 1, bool)
    two = grams.places(2)
    good[two] = seen(pairs, grams.names(two, 2))
    at = grams.places(n)
    ok = np.ones(len(at), bool)
    for i in range(n - 1):
        ok &= good[at + i]
    return at[ok]


def summed(names: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct names and the sums of their counts."""
    order = np.argsort(names)
    names = names[order]
    first = np.flatnonzero(np.append(True, names[1:] != names[:-1])) if len(names) else np.zeros(0, np.int64)
    return names[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def _buckets(names: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of one bucket each: sorted names, counts (cut to 32 bits; more occurrences in one task take several rows)."""
    while len(names):
        now = np.minimum(counts, (1 << 32) - 1)
        number = (names >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(names), np.int64)
        first = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
        last = np.append(first[1:], len(names))
        rows = [(names[a:b].tobytes(), now[a:b].astype("<u4").tobytes()) for a, b in zip(first, last)]
        yield pa.RecordBatch.from_arrays([pa.array(number[first]), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())],
                                         names=["bucket", "names", "counts"])
        rest = counts > now
        names, counts = names[rest], (counts - now)[rest]


def _sum_bucket(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(b"".join(table.column("names").to_pylist()), "<u8")
    return summed(names, np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u4").astype(np.int64))


def frequent(texts: DataFrame, grams_of: Callable[[Grams], Iterator[np.ndarray]], least: int, bucket_bits: int, name: str) -> DataFrame:
    """(name): the fingerprints that ``grams_of`` gives at least ``least`` times over all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        entries = 0
        for batch in batches:
            for piece in slices(batch):
                found = np.concatenate([np.zeros(0, U64), *grams_of(Grams(piece))])
                held.append(summed(found, np.ones(len(found), np.int64)))
                entries += len(held[-1][0])
                if entries > 2 * HELD_ENTRIES:
                    held = [summed(*map(np.concatenate, zip(*held)))]
                    entries = len(held[0][0])
                    if entries > HELD_ENTRIES:
                        yield from _buckets(*held.pop(), bucket_bits)
                        entries = 0
        if held:
            yield from _buckets(*summed(*map(np.concatenate, zip(*held))), bucket_bits)
        pa.default_memory_pool().release_unused()

    def add(table: pa.Table) -> pa.Table:
        names, counts = _sum_bucket(table)
        return pa.table({"name": pa.array(names[counts >= least].view(np.int64))})

    return stored(texts.mapInArrow(count, "bucket long, names binary, counts binary").groupBy("bucket").applyInArrow(add, "name long"), name)


def bitmap_of(found: DataFrame) -> Broadcast:
    """Bitmap of leading bits with 16 to 32 bits per name, but never more than ``MOST_BITS`` bits, for the tasks."""
    bits = min(max(16 * found.count(), 1 << 16).bit_length(), MOST_BITS.bit_length() - 1)
    at = F.shiftrightunsigned("name", 64 - bits)
    pages = found.groupBy(F.shiftright(at, 15).alias("page")).agg(F.bitmap_construct_agg(at.bitwiseAND(32767)).alias("bits")).toPandas()
    out = np.zeros(1 << (bits - 3), np.uint8)
    for page, part in zip(pages["page"], pages["bits"]):
        out[page << 12:(page + 1) << 12] = np.frombuffer(part, np.uint8)
    return found.sparkSession.sparkContext.broadcast(out)


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts data[start:end] as an Arrow array, without Python objects."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    body = data[np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])]
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).cast(pa.string())


def equal_texts(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the substrings of the given length at a and b are equal, eight bytes at a step."""
    padded = np.append(data, np.zeros(8, np.uint8))
    wide = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    same = np.ones(len(a), bool)
    left = np.arange(len(a))
    at = 0
    while len(left):
        rest = np.minimum(length[left] - at, 8)
        mask = np.where(rest == 8, U64(0xFFFFFFFFFFFFFFFF), (U64(1) << (8 * np.minimum(rest, 7)).astype(U64)) - U64(1))
        agree = (wide[a[left] + at] ^ wide[b[left] + at]) & mask == 0
        same[left[~agree]] = False
        at += 8
        left = left[agree & (length[left] > at)]
    return same


def verified(grams: Grams, names: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, last word, count) of each distinct n-gram among the given occurrences, by language and text.

    Occurrences are sorted by fingerprint, and each is compared with the one before it. Where they differ, the group is counted by text.
    """
    order = np.argsort(names, kind="stable")
    names, first, last = names[order], first[order], last[order]
    start, length, lang = grams.starts[first], grams.ends[last] - grams.starts[first], grams.lang[first]
    near = np.flatnonzero(names[1:] == names[:-1])
    near_ok = (length[near] == length[near + 1]) & (lang[near] == lang[near + 1])
    near_ok[near_ok] = equal_texts(grams.data, start[near[near_ok]], start[near[near_ok] + 1], length[near[near_ok]])
    heads = np.flatnonzero(np.append(True, names[1:] != names[:-1])) if len(names) else np.zeros(0, np.int64)
    counts = np.diff(np.append(heads, len(names)))
    bad = np.unique(names[near[~near_ok]])
    if len(bad):
        good = ~np.isin(names[heads], bad)
        pointer: dict[tuple, int] = {}
        tally: Counter = Counter()
        for i in np.flatnonzero(np.isin(names, bad)).tolist():
            key = (lang[i], grams.data[start[i]:start[i] + length[i]].tobytes())
            pointer.setdefault(key, i)
            tally[key] += 1
        heads = np.concatenate([heads[good], np.array(list(pointer.values()), np.int64)])
        counts = np.concatenate([counts[good], np.array([tally[k] for k in pointer], np.int64)])
    return first[heads], last[heads], counts


def counted(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, f): every phrase of 1 to ``longest`` words found ``least`` times or more in a language, and under the empty
    phrase the number of all words of each language."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bucket_bits = min(max(size // BUCKET_BYTES, 255).bit_length(), 40)

    def short(grams: Grams) -> Iterator[np.ndarray]:
        for n in (1, 2):
            yield grams.names(grams.places(n), n)

    pairs = bitmap_of(frequent(texts, short, least, bucket_bits, "pairs"))

    def long(grams: Grams) -> Iterator[np.ndarray]:
        for n in range(3, longest + 1):
            yield grams.names(with_frequent_pairs(grams, pairs.value, n), n)

    longer = bitmap_of(frequent(texts, long, least, bucket_bits, "longer"))

    def phrases(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        grams = Grams(batch)
        names, first, last = [], [], []
        for n in range(1, longest + 1):
            at = grams.places(n) if n < 3 else with_frequent_pairs(grams, pairs.value, n)
            found = grams.names(at, n)
            ok = seen((pairs if n < 3 else longer).value, found)
            names.append(found[ok])
            first.append(at[ok])
            last.append(at[ok] + n - 1)
        a, b, counts = verified(grams, *map(np.concatenate, (names, first, last)))
        langs = pa.array(grams.langs, pa.string())
        words = np.bincount(grams.lang, minlength=len(grams.langs))
        for code, phrase, f in ((grams.lang[a], cut(grams.data, grams.starts[a], grams.ends[b]), counts),
                                (np.arange(len(words)), pa.array([""] * len(words), pa.string()), words)):
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(code)), phrase, pa.array(f.astype(np.int64))], names=["lang", "phrase", "f"])

    found = map_batches(texts, phrases, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return stored(found.filter((F.col("f") >= least) | (F.col("phrase") == "")), "phrases")


def ranked(counts: DataFrame, top: int = TOP, cover: int = COVER) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best ``top`` phrases of each language from ``counted`` rows.

    A phrase is as good as its weakest cut: ``SCALE * a / (l + r)``, rounded down, in exact decimal arithmetic. Phrases inside a longer
    one that makes up ``cover`` percent of their occurrences are left out.
    """
    parts = counts.filter("phrase <> ''")
    words = F.split("phrase", " ")
    whole = parts.filter("instr(phrase, ' ') > 0").withColumnRenamed("f", "a").withColumn("words", words)
    part = lambda x, i, n: F.array_join(F.slice(x, i, n), " ")
    cuts = whole.withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)"))).select(
        "lang", "phrase", "a", "k", part("words", F.lit(1), F.col("k")).alias("head"), part("words", F.col("k") + 1, F.size("words")).alias("tail"))
    for side, f in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(f)), ["lang", side])
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = cuts.withColumn("score", F.expr(f"(cast(a as decimal(20,0)) * {SCALE}BD) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    scores = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    longer = whole.filter("size(words) > 2").withColumn("m", F.explode(F.expr("sequence(2, size(words) - 1)"))).withColumn(
        "i", F.explode(F.expr("sequence(1, size(words) - m + 1)")))
    inside = longer.select("lang", part("words", F.col("i"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("outer"))
    kept = scores.join(inside, ["lang", "phrase"], "left").filter(F.col("outer").isNull() | (exact("outer") * 100 < exact("a") * cover))

    best = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    kept = kept.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
    totals = counts.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "best.l", "best.r", "n", "best.score")
