import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarn.llm import phrases as p

SCHEMA = "doc_id long, text string, lang string, phrase int, f string, n long, score int"
LOWER = {c: c + 32 for c in range(65, 91)}


def count(rows, least):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words, own = re.findall("[^ \t]+", piece), "und" if lang is None else lang
            n[own] += len(words)
            for k in range(1, 5):
                f.update((own, *words[i:i + k]) for i in range(len(words) - k + 1))
    return {k: v for k, v in f.items() if v >= least}, n


def brute(rows, least=30, top=2000):
    f, n = count(rows, least)
    found = {}
    for key, a in f.items():
        lang, *w = key
        if len(w) < 2:
            continue
        score, k = min((2_000_000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        found[key] = (score, a, f[(lang, *w[:k])], f[(lang, *w[k:])])
    dropped = set()
    for key, a in f.items():
        lang, *w = key
        for m in range(2, len(w)):
            dropped |= {s for i in range(len(w) - m + 1) if 100 * a >= 80 * f[s := (lang, *w[i:i + m])]}
    out = []
    for lang in n:
        best = sorted(((-s, -a, " ".join(k[1:]).encode(), l, r) for k, (s, a, l, r) in found.items() if k[0] == lang and k not in dropped))[:top]
        out += [(lang, i, x.decode(), -a, l, r, n[lang], -s) for i, (s, a, x, l, r) in enumerate(best, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "x", 2, 3) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(5)


def texts(n, seed=2):
    r = random.Random(seed)
    words = ["the", "The", "of", "New", "York", "city", "a", "é", "x-y", "«q»", "zz", "日本", "b\xa0c", "'"]
    weights = [1 / (i + 1) for i in range(len(words))]
    glue = [" "] * 20 + ["  ", "\t ", ", ", ".", "!?", "\n", "\r\n ", "\x0b", " ; "]
    rows = []
    for _ in range(n):
        text = "".join(x for _ in range(r.randrange(0, 60)) for x in ("New York city" if r.random() < 0.1 else r.choices(words, weights)[0], r.choice(glue)))
        rows.append((r.choice([text] * 12 + [None, "", " \t.", text.strip()]), r.choice(["en"] * 6 + ["de", None, "und", ""])))
    return rows


def test_equals_brute_force(spark):
    rows = texts(900)
    rows += rows[:30] + [("word " * 50_000 + "w" * 100_000, "fr"), ("a b c d e " * 29, "es"), ("a b c d e. " * 30, "pt"), ("a " * 30, "it"), (" a" * 31, "it2")]
    got = sorted(map(tuple, p.ranked(p.counted(table(spark, rows))).collect()))
    assert got == brute(rows)
    assert {x[0] for x in got} >= {"en", "und", "fr", "pt", "it2"} and not {"es", "it"} & {x[0] for x in got}


def test_colliding_fingerprints_change_nothing(spark, monkeypatch):
    rows = texts(300, 5)

    def few(self, at, n):
        return p.mix(p.substring_names(self.prefix, self.starts[at], self.ends[at + n - 1]) % p.U64(37))

    real = p.Grams.names
    try:
        p.Grams.names = few  # the batch function by itself
        batch = pa.RecordBatch.from_pydict({"text": [t for t, _ in rows], "lang": ["und" if x is None else x for _, x in rows]})
        grams = p.Grams(batch)
        got = Counter()
        at = [grams.places(n) for n in range(1, 5)]
        names = np.concatenate([grams.names(a, n) for n, a in enumerate(at, 1)])
        first, last, counts = p.verified(grams, names, np.concatenate(at), np.concatenate([a + n - 1 for n, a in enumerate(at, 1)]))
        phrase = p.cut(grams.data, grams.starts[first], grams.ends[last]).to_pylist()
        for i, t in enumerate(phrase):
            got[(grams.langs[grams.lang[first[i]]], *t.split(" "))] += int(counts[i])
        assert got == count(rows, 1)[0]
    finally:
        p.Grams.names = real


def test_saturated_bitmap_changes_nothing(spark, monkeypatch):
    rows = texts(200, 6)
    monkeypatch.setattr(p, "MOST_BITS", 1 << 16)
    full = spark.sparkContext.broadcast(np.full(1 << 13, 255, np.uint8))
    monkeypatch.setattr(p, "bitmap_of", lambda found: full)
    assert sorted(map(tuple, p.ranked(p.counted(table(spark, rows))).collect())) == brute(rows)


def test_top_and_exact_scores_of_large_counts(spark):
    big = 4 * 10 ** 18
    counts = spark.createDataFrame([("en", "", big), ("en", "a", big), ("en", "b", big - 1), ("en", "a b", big - 2), ("en", "c", 40), ("en", "a c", 30)],
                                   "lang string, phrase string, f long")
    assert sorted((tuple(x) for x in p.ranked(counts).collect()), key=lambda x: x[1]) == [("en", 1, "a b", big - 2, big, big - 1, big, 2_000_000 * (big - 2) // (2 * big - 1)),
                                                              ("en", 2, "a c", 30, big, 40, big, 0)]
    assert [x.rank for x in p.ranked(counts, top=1).collect()] == [1]


@pytest.mark.parametrize("rows", [[], [(None, None)], [("", "en"), ("a", "en")]])
def test_no_phrases(spark, rows):
    assert p.ranked(p.counted(table(spark, rows))).collect() == []


def test_bitmap_holds_all_names(spark):
    names = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 5000)
    found = spark.createDataFrame([(int(x),) for x in names], "name long")
    bitmap = p.bitmap_of(found).value
    assert p.seen(bitmap, names.view(np.uint64)).all()
    other = np.random.default_rng(2).integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert p.seen(bitmap, other).mean() < 0.08
