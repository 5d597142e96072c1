import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tarn.llm import catalog, merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree int, path string, digest string, pos long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_digest(r):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"])])


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)}) if text is not None else None


def climb(leaves):
    """All levels up to the one with a single node."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 8 * 8
        out.append(([*level[first:i]], [*level[i + 1:first + 8]]))
        i //= 8
    return out


def expected(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for k in order:
        trees[k].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, row_digest(r)))
        built[k] = climb([row_digest(r) for r in trees[k]])
    top = climb([built[k][-1][0] for k in order])
    out = []
    for i, k in enumerate(order):
        for j, r in enumerate(trees[k]):
            path = siblings(built[k], j) + siblings(top, i)
            seen = dict(r, text=lower(r["text"])) if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 else r
            node = row_digest(seen)
            for a, b in path:
                node = h(*a, node, *b)
            out.append((r["doc_id"], row_digest(r), built[k][-1][0], top[-1][0], h(*[x for a, b in path for x in a + b]), node, node == top[-1][0]))
    return out


def check(spark, tmp_path, rows):
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], 1, "x", "y", 3) for r in rows], SCHEMA).repartition(5)
    df.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["op12_merkle_manifest"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    by = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(tuple, got.collect()), key=by) == sorted(expected(rows), key=by)


def make(n, langs, seed=1):
    r = random.Random(seed)
    return [{"doc_id": i if r.random() > 0.02 else None, "text": r.choice(["", None, f"Text {i}", f"text é {i}", "Same"]), "n_chars": r.choice([None, 5]),
             "lang": r.choice(langs), "source": r.choice(["a", None, "-"])} for i in range(n)]


def test_many_levels_hot_tree_and_null_tree(spark, tmp_path):
    rows = make(1200, ["en"] * 30 + [None, "", "de", "zz", "é", "Z"])
    check(spark, tmp_path, rows + rows[:40] + [{"doc_id": 5000, "text": "Long " * 40_000, "lang": "en", "source": "s", "n_chars": 1}])


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 64, 65, 512, 513, 520])
def test_sizes_around_full_levels(spark, tmp_path, n):
    check(spark, tmp_path, make(n, ["en"], n))


def test_more_trees_than_one_run(spark, tmp_path):
    check(spark, tmp_path, make(300, [f"l{i}" for i in range(70)]))


def test_paths_are_real_siblings_and_only_every_third_level_is_stored(spark):
    rows = make(1100, ["en"])
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], 1, "x", "y", 3) for r in rows], SCHEMA)
    m = merkle.build(df)
    assert [x.count() for x in m.trees.levels] == [1100, 3, 1]
    one = m.proofs().filter("tree = '=en' AND pos = 700").withColumn("folded", merkle.folded(F.col("leaf"), F.col("path"))).first()
    rows.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, row_digest(r)))
    levels = climb([row_digest(r) for r in rows])
    assert [(x.before, x.after) for x in one.path] == [("".join(a), "".join(b)) for a, b in siblings(levels, 700)]
    assert one.folded == one.root == m.root == levels[-1][0]
