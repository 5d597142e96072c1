"""Columns of the documents whose names clash with those that operators use inside, and ids that are no whole numbers."""

import pytest

from tarn.llm import decontaminate, mixing, quality, setsketch, substrings

CLASHING = ["_kept", "_base_failed", "_quality_stats", "_row_id", "_row_hash", "row_id", "row_hash", "_spans", "spans", "_hash", "_id", "_size",
            "_words", "_number", "_nth", "_taken", "_text_hash", "label", "n_words", "body", "passed0", "doc.id", "first_id"]
BENCHMARK = "one two three four five six seven eight nine ten eleven twelve"


def words(seed: int, n: int = 80) -> str:
    return " ".join(f"w{seed}x{i * 7919 % 1009}" for i in range(n))


def given(spark, text_ids: bool = False):
    texts = [words(1), words(1), words(2), words(3) + " " + BENCHMARK, "short", "", None]
    name = (lambda i: f"doc-{i}") if text_ids else (lambda i: i)
    rows = [(name(i + 1), t, "web" if i % 2 else None, *[f"{c}-{i}" for c in CLASHING]) for i, t in enumerate(texts)]
    rows.append((None, words(4), "web", *[f"{c}-null" for c in CLASHING]))
    kind = "string" if text_ids else "long"
    return spark.createDataFrame(rows, f"doc_id {kind}, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASHING))


def benchmark(spark):
    return spark.createDataFrame([("b1", BENCHMARK)], "item_id string, text string")


def labels(spark):
    return spark.createDataFrame([], "doc_id long, quality long")


def unchanged(docs, out):
    assert out.columns == docs.columns
    at = docs.columns.index("_kept")
    own = {r[at:]: r[0] for r in docs.collect()}
    rows = out.collect()
    assert all(own[r[at:]] == r[0] for r in rows)
    return rows


def ids(rows):
    return sorted(str(r[0]) for r in rows)


@pytest.mark.parametrize("text_ids", [False, True])
def test_other_columns_pass_whatever_their_names(spark, text_ids):
    docs = given(spark, text_ids)
    name = (lambda i: f"doc-{i}") if text_ids else str
    kept = unchanged(docs, setsketch.keep_one(docs))
    assert ids(kept) == sorted(["None", *[name(i) for i in (1, 3, 4, 5, 6, 7)]])
    clean = unchanged(docs, decontaminate.remove_passages(docs, benchmark(spark)))
    assert ids(clean) == sorted(["None", *[name(i) for i in (1, 2, 3, 5, 6, 7)]])
    cut = unchanged(docs, decontaminate.remove_passages(docs, benchmark(spark), whole=False))
    texts = {str(r.doc_id): r.text for r in cut}
    assert len(cut) == 8 and texts[name(4)].strip() == words(3) and texts[name(5)] == "short" and texts[name(7)] is None
    mix = unchanged(docs, mixing.mixed(docs, block=10, spread=8.0))
    assert mix and not {name(6), name(7)} & set(ids(mix))


def test_quality_keeps_clashing_columns(spark):
    docs = given(spark)
    good = unchanged(docs, quality.keep_good(docs, labels(spark)))
    assert ids(good) == sorted(["None", "1", "2", "3", "4"])
    judged = quality.judged(docs, labels(spark))
    assert [c for c in judged.columns if c in CLASHING] and judged.filter("_kept").count() == 5


def test_text_ids_name_components_and_removals(spark):
    docs = given(spark, text_ids=True)
    found = {r.doc_id: r for r in setsketch.near_duplicates(docs).collect()}
    assert found["doc-2"].component_id == "doc-1" and not found["doc-2"].kept and found["doc-3"].kept
    removed = {r.doc_id: r for r in substrings.remove_repeats(docs).collect()}
    assert len(removed) == 8 and len(removed["doc-1"].kept) < 100 and not removed["doc-3"].spans


def test_ids_that_look_alike_stay_apart(spark):
    docs = spark.createDataFrame([("1", "tiny"), ("01", "tiny"), ("1.0", "tiny"), (None, "tiny")], "doc_id string, text string")
    assert len({(r.row_id, r.row_hash) for r in docs.select(*quality_keys()).collect()}) == 4


def quality_keys():
    from tarn.llm.common import row_keys
    return row_keys()
