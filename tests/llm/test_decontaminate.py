import hashlib
import random
import re

from tarn.llm.decontaminate import find_passages, remove_passages

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for d, text in rows:
        w, hit, ids = words(text), set(), set()
        for i in range(len(w)):
            for n in range(1, 11):
                if i + n <= len(w) and tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids |= windows[tuple(w[i:i + n])]
        names = sorted(str(i) for i in ids if i is not None)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest()))
    return sorted(out, key=str)


def data():
    r = random.Random(5)
    make = lambda n: " ".join(r.choice(["Ab", "é", "x9", "the", "of"]) + str(r.randrange(40)) for _ in range(n))
    items = [(i, make(r.choice([2, 3, 9, 10, 14, 30]))) for i in range(30)] + [(90, None), (91, "..."), (92, make(12)), (93, "only"), (None, "null item text")]
    items.append((94, items[0][1]))
    rows = []
    for i in range(120):
        parts = [make(r.randrange(12)) for _ in range(3)]
        if r.random() < 0.5:
            parts.insert(1, items[r.randrange(30)][1].upper().replace(" ", ", ") if r.random() < 0.5 else items[r.randrange(30)][1])
        if r.random() < 0.3:
            parts.append(" ".join(items[r.randrange(30)][1].split()[:9]))
        rows.append((i, "\n".join(parts)))
    return rows + [(500, None), (501, ""), (502, "!!"), (503, "so only"), (None, rows[0][1]), (None, None), (504, "a null item text b"), rows[1]], items


def test_equals_brute_force_in_one_or_more_passes(spark):
    rows, items = data()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for per_pass in (10_000, 100):
        got = find_passages(docs, bench, per_pass=per_pass).collect()
        assert sorted(((x.doc_id, x.n_words, x.n_hit, x.n_items, x.items_sha256) for x in got), key=str) == brute(rows, items)


def test_removal(spark):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "A one, TWO three. B", 7), (2, "one two", 8), (3, None, 9), (1, "A one, TWO three. B", 7)],
                                 "doc_id long, text string, spans int")
    assert sorted(r.doc_id for r in remove_passages(docs, bench).collect()) == [2, 3]
    cut = sorted((tuple(r) for r in remove_passages(docs, bench, whole=False).collect()), key=str)
    assert cut == [(1, "A . B", 7), (1, "A . B", 7), (2, "one two", 8), (3, None, 9)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert find_passages(docs.limit(0), bench).collect() == []
    assert find_passages(docs, bench.limit(0)).first().n_hit == 0
    assert find_passages(docs, bench).first().items == ["1"]


def test_one_python_step_over_the_texts(spark):
    """Two in one stage are two worker processes for each task, and executors keep them."""
    docs = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([("a", "two three")], "item_id string, text string")
    out = find_passages(docs, items)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in out.collect()) == [(1, 3, 2, 1), (2, 0, 0, 0)]
