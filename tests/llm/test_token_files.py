import struct
import zlib

import pytest

from tarn.llm.token_files import read_tokens, token_index, write_tokens
from tarn.llm.tokens import Encoder, word_bpe

ODD = ["", "It's We'll THE o'clock 'tis don't''", "naïve Straße ÉCOLE école café KK", "a b c\u0085d\x0be\x0cf\x1cg",
       "x <|endoftext|> y <|ENDOFTEXT|> <|startoftext|>", "12345 a1b2 ½ ² ́ .́ ≯", "...!!! a.b,c ((x)) a--b %%% ***", "漢字 かな 한글 русский ΣΑΣ ŐŰ İI ǅ",
       "ﬁ ﬀ ª º µ ß ÿ ÷ ×", "tab\tline\nfeed\r\nend ", "emoji 👍🏽 👩‍👩‍👧", "word, word. Word! WORD? word;", "﻿bom​zero­soft", "ñ ñandú Ñ açaí ö Ö"]


def texts(spark, d):
    return [r.text for r in spark.read.parquet(f"/root/testdata/{d}/documents.parquet").collect()]


def test_pieces_equal_whole_texts(spark):
    e = Encoder(word_bpe())
    rows = ODD + texts(spark, "sf0.001")
    for _ in range(2):
        got = e.encode([t.encode() for t in rows] + [None])
        want = [x.ids for x in e.tokenizer.encode_batch(rows, add_special_tokens=False)]
        assert [list(struct.unpack(f"<{len(b) // 4}I", b)) for b in got] == want + [[]]


def test_round_trip(spark, tmp_path):
    docs = [(i * 3 % 41, t) for i, t in enumerate(ODD)] + [(100, None), (101, ""), (None, "null id"), (2, "again"), (2, "again"), (102, "word " * 20000)]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, ids int, shard int")
    path = str(tmp_path / "t")
    write_tokens(df, path, word_bpe())
    got = {}
    for r in token_index(spark, path).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    e = Encoder(word_bpe())
    want, at = {}, 0
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    for i, t in order:
        ids = e.tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.setdefault(i, []).append((at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert got.keys() == want.keys()
    for k in want:
        assert sorted(x[1:] for x in got[k]) == sorted(x[1:] for x in want[k])
        assert sorted(got[k])[0][0] == want[k][0][0]
    one = read_tokens(spark, path).filter("doc_id = 102")
    assert len(one.first().ids) == 20001
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,102)]" in one._jdf.queryExecution().toString()


@pytest.mark.parametrize("rows", [[], [(5, None)]])
def test_small_tables(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    write_tokens(df, str(tmp_path / "t"), word_bpe())
    assert [(r.doc_id, r.start, r.n_tokens) for r in token_index(spark, str(tmp_path / "t")).collect()] == [(5, 0, 1)] * len(rows)


def test_text_ids_come_back(spark, tmp_path):
    df = spark.createDataFrame([("b", "one two"), ("a", "three"), (None, None)], "doc_id string, text string")
    write_tokens(df, str(tmp_path / "t"), word_bpe())
    got = token_index(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [(r.doc_id, r.start) for r in got][:2] == [(None, 0), ("a", 1)] and got[2].doc_id == "b"


def test_words_with_digits_and_marks_are_encoded_whole():
    e = Encoder(word_bpe())
    rows = ["x1 x1, x1. a, a,, ,a é. é é1 é1, ß+ 1 1. ..", "x1, x1 A, É1, a1.b, ,"]
    for t in rows + rows:
        assert list(struct.unpack(f"<{len(b := e.encode([t.encode()])[0]) // 4}I", b)) == e.tokenizer.encode(t, add_special_tokens=False).ids
