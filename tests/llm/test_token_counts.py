import re

import pytest

from tarn.llm import token_counts as tc
from tarn.llm.tokens import Encoder, word_bpe


def rows(spark, data, columns="source string, lang string, tokenizer string, n_tokens long"):
    return spark.createDataFrame(data, columns)


def totals(ledger):
    return sorted((tuple(r) for r in ledger.totals().collect()), key=str)


def test_signed_changes_replays_and_snapshots(spark, tmp_path):
    ledger = tc.Ledger(spark, str(tmp_path / "l"))
    assert totals(ledger) == [] and ledger.committed() == []
    a, b, n = ("s", "en", "v1"), ("s", "de", "v1"), (None, None, "v1")
    first = rows(spark, [(*a, 10), (*a, 5), (*b, 7), (*n, 1), (*n, None)])
    assert ledger.commit("b1", tc.inserts(first)) and not ledger.commit("b1", tc.inserts(first))
    assert totals(ledger) == sorted([(*a, 2, 15), (*b, 1, 7), (*n, 2, 1)], key=str)
    change = rows(spark, [(*a, 6, 5)], "source string, lang string, tokenizer string, n_tokens long, old_tokens long")
    ledger.commit("b2", tc.revisions(change), tc.deletes(rows(spark, [(*b, 7)])), tc.inserts(rows(spark, [("s", "en", "v2", 9)])))
    want = sorted([(*a, 2, 16), (*n, 2, 1), ("s", "en", "v2", 1, 9)], key=str)
    assert totals(ledger) == want
    ledger.compact()
    assert totals(ledger) == want and ledger.committed() == ["b1", "b2"]
    assert not ledger.commit("b2", tc.inserts(first)) and totals(ledger) == want
    ledger.commit("b3", tc.deletes(rows(spark, [("s", "en", "v2", 9)])))
    ledger.compact()
    assert totals(ledger) == [w for w in want if w[2] != "v2"]


def test_an_interrupted_batch_does_not_count(spark, tmp_path):
    ledger = tc.Ledger(spark, str(tmp_path / "l"))
    one = rows(spark, [("s", "en", "v", 3)])
    ledger.commit("b1", tc.inserts(one))
    (tmp_path / "l" / "batches" / "b1" / "_SUCCESS").unlink()  # as if the writer had died before the end
    assert totals(ledger) == []
    assert ledger.commit("b1", tc.inserts(one)) and totals(ledger) == [("s", "en", "v", 1, 3)]
    with pytest.raises(ValueError):
        ledger.commit("../x", tc.inserts(one))


def test_query_equals_plain_counting(spark):
    from tarn.llm.catalog import QUERIES

    d = "/root/testdata/sf0.001"
    e, want = Encoder(word_bpe()), {}
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        if len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) >= 5:
            n = len(e.tokenizer.encode(re.sub(r"[#*$%&|<>]", "", r.text), add_special_tokens=False).ids)
            docs, tokens = want.get((r.source, r.lang), (0, 0))
            want[r.source, r.lang] = docs + 1, tokens + n
    got = {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in QUERIES["op1_token_counts"](spark, d).collect()}
    assert got == want


def test_odd_texts(spark):
    docs = spark.createDataFrame([(1, None, "s", None, 5), (2, "", None, "en", 5), (3, "###", "s", "en", 5), (3, "a b", "s", "en", 5)],
                                 "doc_id long, text string, source string, lang string, n_tokens int")
    got = sorted((r.doc_id, r.n_tokens, r.clean_tokens) for r in tc.counted(docs, word_bpe(), "v").collect())
    assert got == [(1, 0, 0), (2, 0, 0), (3, 2, 0), (3, 2, 2)]
    assert tc.counted(docs.limit(0), word_bpe(), "v").collect() == []


def test_a_batch_committed_during_compaction_counts_once(spark, tmp_path):
    ledger = tc.Ledger(spark, str(tmp_path / "ledger"))
    rows = lambda n: tc.inserts(spark.createDataFrame([("s", "en", "t", n)], "source string, lang string, tokenizer string, n_tokens long"))
    ledger.commit("one", rows(10))
    real = ledger._folders

    def meanwhile(kind):
        found = real(kind)
        if kind == "batches":
            ledger._folders = real
            ledger.commit("two", rows(5))
        return found

    ledger._folders = meanwhile
    ledger.compact()
    assert [r.n_tokens for r in ledger.totals().collect()] == [15]
    ledger.compact()
    assert [r.n_tokens for r in ledger.totals().collect()] == [15] and ledger.committed() == ["one", "two"]
