import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tarn.llm import mixing as m


def plain_targets(sizes, weights=(1, 2, 3), repeats=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(sizes.values())
    while free:
        share = left / sum(w[s] for s in free)
        above = [s for s in free if w[s] * share > repeats * sizes[s]]
        if not above:
            target |= {s: w[s] * share for s in free}
            break
        for s in above:
            target[s] = repeats * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


def plain_seats(sizes, seats):
    won = Counter()
    for _ in range(seats):
        best = max((s for s in sizes if sizes[s] > 0), key=lambda s: (sizes[s] / (2 * won[s] + 1), -s))
        won[best] += 1
    return won


def test_apportionment_equals_seat_by_seat(spark):
    r = random.Random(4)
    rows, want = [], {}
    for g in range(12):
        sizes = {i: float(r.choice([0, 1, r.randrange(5), r.randrange(1000)])) for i in range(r.randrange(1, 30))}
        seats = r.choice([0, 1, 7, 100, 700])
        rows += [(g, i, v, seats) for i, v in sizes.items()]
        want |= {(g, i): n for i, n in (plain_seats(sizes, seats) if sum(sizes.values()) else {}).items()}
    got = m.apportion(spark.createDataFrame(rows, "g int, part int, size double, seats long"), ["g"], "seats", "size", ["part"]).collect()
    assert {(x.g, x.part): x.quota for x in got if x.quota} == {k: v for k, v in want.items() if v}
    assert len(got) == len(rows)


def documents(spark, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(700):
        source = r.choice(["a", "a", "a", "B", "é", "tiny", None, "z1", "z2"])
        n = r.randrange(3) if source == "tiny" else r.randrange(1, 200)
        rows.append((i, " ".join(f"w{r.randrange(50)}" for _ in range(n)), source, 1))
    rows += [(1000, None, "a", 1), (1001, "", "void", 1), (1002, None, "void", 1), (None, "x y z", "a", 1), rows[0], rows[0]]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target int"), rows


@pytest.mark.parametrize("spread", [4, 1])
def test_mixture_keeps_targets_and_limits(spark, spread):
    df, rows = documents(spark)
    sizes = defaultdict(int)
    for _, t, s, _ in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = plain_targets(sizes)
    got = m.mixture(df.withColumn("x", F.lit(1)), spread=spread).join(df.select("doc_id", "source").distinct(), "doc_id", "left").collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for x in got:
        assert x.taken <= 3 * x.size and x.size <= x.source_size
        if x.doc_id is not None:
            assert x.source_size == sizes[x.source] and abs(x.target - want[x.source]) < 1e-6
            taken[x.source] += x.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.03 * want[s], 64 * 26 / spread), s
    again = m.mixture(df.repartition(5), spread=spread).collect()
    assert sorted((x.doc_id or -1, x.taken) for x in again) == sorted((x.doc_id or -1, x.taken) for x in got)


def test_mixed_rows_hold_what_was_taken(spark):
    df, rows = documents(spark, 2)
    taken = sum(x.taken for x in m.mixture(df).collect())
    out = m.mixed(df)
    assert out.columns == df.columns
    assert sum(len((x.text or "").split()) for x in out.collect()) == taken


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert m.mixture(df).collect() == []
    one = m.mixture(spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")).first()
    assert (one.size, one.source_size, one.target, one.taken) == (0, 0, 0.0, 0)
