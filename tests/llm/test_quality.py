import re
from collections import Counter

import numpy as np

from tarn.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)]


def test_counts_equal_plain_counting(spark):
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rows += ["", None, " \n\n", "a", "a b c a b c", "x\r\nx\r\n", "é é é é é", "a\x0bb\x1cc\xa0d", "l\nl\n\nl", "a b\n", "<|>#" * 5, "q w e " * 5000, "end\na", "a"]
    got = q.text_counts([None if t is None else t.encode() for t in rows])
    assert got[:, :5].tolist() == [plain(t) for t in rows]


def test_learned_list_finds_planted_rules_and_equals_its_expression(spark):
    r = np.random.default_rng(2)
    n = 3000
    counts = {c: r.integers(50, 400, n) for c in q.COUNTS}
    x = q.feature_matrix(counts)
    bad = ((x[:, list(q.FEATURES).index("upper_share")] > 2.5) & (counts["n_words"] > 150)) | (x[:, list(q.FEATURES).index("symbol_share")] > 4)
    rules = q.learn(x, bad)
    assert rules.rules and (rules.rejects(x) == bad).mean() > 0.97
    assert q.learn(x, np.zeros(n, bool)).rules == []
    df = spark.createDataFrame([tuple(int(counts[c][i]) for c in q.COUNTS) for i in range(n)], [*q.COUNTS])
    from pyspark.sql import functions as F
    got = df.select(F.struct(*q.COUNTS).alias(q.STATS)).select(rules.keep().alias("k")).toPandas()["k"].to_numpy()
    assert (got == ~rules.rejects(x)).all()


def test_labels_and_odd_tables(spark):
    good = " ".join(f"w{i}" for i in range(60))
    loud = " ".join(f"W{i}!!" for i in range(60)).upper()
    rows = [(i, (loud if i % 4 == 0 else good) + f" t{i}", 5, "q") for i in range(80)] + [(None, good, 1, "x"), (90, None, 2, "x"), (91, "", 2, "x"), (91, "", 2, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, quality string")
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1) for i in range(80)] + [(None, 0), (90, None), (91, 0)], "doc_id long, quality int")
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*[i for i in range(80) if i % 4], None], key=str)
    assert q.keep_good(docs, labels.limit(0)).count() == 81
    assert q.keep_good(docs.limit(0), labels).collect() == []


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    train, test = labels.filter("doc_id % 3 > 0"), labels.filter("doc_id % 3 = 0")
    got = q.judged(docs, train).join(test, "doc_id").toPandas()
    assert ((got["_kept"] == 0) & (got["quality"] == 1) & ~got["_base_failed"]).mean() < 0.05
    assert got["_kept"][got["quality"] == 0].mean() < 0.3
