import hashlib
import random

from tarn.llm.doubling import spans_by_doubling
from tarn.llm.substrings import remove_repeats


def brute(rows, length):
    where = {}
    bodies = [(t or "").encode() for _, t in rows]
    for r, b in enumerate(bodies):
        for i in range(len(b) - length + 1):
            where.setdefault(b[i:i + length], []).append((r, i))
    hit = [bytearray(len(b)) for b in bodies]
    for places in where.values():
        if len(places) > 1:
            for r, i in places:
                hit[r][i:i + length] = b"\1" * length
    out = []
    for (doc_id, _), b, h in zip(rows, bodies, hit):
        kept = bytes(x for x, y in zip(b, h) if not y)
        spans = sum(1 for i in range(len(h)) if h[i] and (i == 0 or not h[i - 1]))
        out.append((doc_id, len(b), hashlib.sha256(kept).hexdigest(), spans))
    return sorted(out, key=str)


def corpus(seed):
    r = random.Random(seed)
    words = [("wörd" if i % 5 == 0 else "w") + str(i) for i in range(300)]
    make = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared = [make(40) for _ in range(4)]
    rows = [(i, make(r.randrange(5, 60)) + r.choice([*shared, ""]) + make(r.randrange(1, 50))) for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(5)]
    edited = rows[7][1]
    rows += [(200, edited[:90] + "#" + edited[91:]), (201, edited[3:]), (202, edited[:-5])]
    rows += [(300, "ab" * 300), (301, "a" * 500), (302, ""), (303, None), (None, rows[3][1]), (None, None), (5, rows[5][1])]
    return rows


def run(spark, rows, length, widths=(1,), find=None):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_repeats(df, length, widths, find).collect()
    return sorted(((r.doc_id, r.n_bytes, hashlib.sha256(bytes(r.kept)).hexdigest(), len(r.spans)) for r in got), key=str)


def test_equals_brute_force(spark):
    rows = corpus(1)
    assert run(spark, rows, 100, (65, 9, 1)) == brute(rows, 100)
    assert run(spark, rows, 400, (257, 17, 1)) == brute(rows, 400)


def test_prefix_doubling_equals_brute_force(spark, monkeypatch):
    import tarn.llm.doubling as d

    rows = corpus(2)
    monkeypatch.setattr(d, "PIECE", 100)
    assert run(spark, rows, 100, find=spans_by_doubling) == brute(rows, 100)
    monkeypatch.undo()
    assert run(spark, rows, 400, find=spans_by_doubling) == brute(rows, 400)
    assert run(spark, [(1, ""), (2, None), (3, "short")], 16, find=spans_by_doubling) == brute([(1, ""), (2, None), (3, "short")], 16)


def test_segments_of_long_texts(spark, monkeypatch):
    import tarn.llm.substrings as s

    texts = [b"".join(bytes([97 + (i * i + j) % 26]) for j in range(7) for i in range(90)) for _ in range(2)]
    whole = s._choose(texts, [[0], [0]], [[len(t) - 100] for t in texts], 100, 9)
    assert len(set(whole[4])) < len(whole[4])
    monkeypatch.setattr(s, "SEGMENT", 150)
    pieces = list(s._segments([1], [1], [texts[0]], None, 100))
    assert [p[2] for p in pieces] == list(range(0, len(texts[0]) - 99, 150))
    assert sum(b - a + 1 for p in pieces for a, b in p[4]) == len(texts[0]) - 99


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, row_id string, body int, rank int")
    assert remove_repeats(df).collect() == []
    df = spark.createDataFrame([(1, "x" * 900, "q", 1)], "doc_id long, text string, row_id string, spans int")
    row = remove_repeats(df).first()
    assert (row.n_bytes, bytes(row.kept), len(row.spans)) == (900, b"", 1)
