import random
import zlib

import numpy as np
import pytest

from tarn.llm import catalog
from tarn.llm import language as la

SCHEMA = "doc_id long, text string, lang string, source string, held_out int, lang_pred string, score string, size int, turn int"
SYLLABLES = {"aa": ["ka", "to", "mi", "ne", "ra", "su"], "bb": ["sch", "ung", "ein", "ber", "ög", "au"], "cc": ["ção", "lh", "os", "ei", "nh", "ra"]}


def plain_spectrum(text):
    low = text.lower()
    plain = " " + " ".join("".join(c if c.isalpha() else " " for c in low).split()) + " "
    return {plain[i:i + n] for n in range(1, la.LONGEST + 1) for i in range(len(plain) - n + 1)} if plain.strip() else None


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 7, "x", "y", 1, 2) for i, t, lang in rows], SCHEMA).repartition(5)


def sentences(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 5))) + r.choice(["", "", "", ",", ".\n", " 12 "]) for _ in range(n))


def corpus(n=600, seed=4):
    r = random.Random(seed)
    langs = r.choices(["aa", "bb", "cc"], [6, 2, 1], k=n)
    return [(i, sentences(r, x, r.randrange(5, 80)), x) for i, x in enumerate(langs)]


@pytest.mark.parametrize("texts", [["", None, "a", "Ab aB", "...", "x1y", " é É ", "İI ǅ ß", "日本 語", "a" * 1000, "Ab aB"], [None], [""], ["one"]])
def test_spectra_are_distinct_ngrams(texts):
    got = la.spectra(texts)
    names = {}
    for t, found in zip(texts, got):
        want = plain_spectrum(t or "")
        assert (found is None) == (want is None)
        if want is not None:
            assert len(found) == len(want)
            names.setdefault(frozenset(want), found)
            assert (names[frozenset(want)] == found).all()


def test_kernel_equals_plain_sets():
    rows = corpus(60)
    marks, texts = [t for _, t, _ in rows[:12]], [t for _, t, _ in rows[12:]] + ["", "123", "zzz"]
    landmarks = la.Landmarks.of(marks)
    sets = [plain_spectrum(t) for t in marks]
    shared = {g for s in sets for g in s if sum(g in x for x in sets) > 1}
    got, known = landmarks.kernel(texts)
    for t, row, ok in zip(texts, got, known):
        mine = (plain_spectrum(t) or set()) & shared
        want = [len(mine & s) / max((len(mine) * len(s & shared)) ** 0.5, 1) for s in sets]
        assert np.allclose(row, want, atol=1e-5) and ok == (plain_spectrum(t) is not None)


def test_held_out_languages_are_found(spark, tmp_path):
    rows = corpus()
    extra = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 ...", "bb"), (None, rows[0][1], None), (1003, "ka tomi " * 30_000, None), *rows[:5]]
    wrong = [(i, t, "bb" if i % 29 == 0 else x) for i, t, x in rows]
    table(spark, wrong + extra).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["op11_language_id"](spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    found = {}
    for x in got.collect():
        found.setdefault(x.doc_id, []).append(x)
        assert 0 <= x.score <= 1
    assert sum(map(len, found.values())) == len(rows) + len(extra)
    held = [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held == [i for i in range(len(rows)) if found[i][0].held_out] and not found[None][0].held_out
    assert sum(found[i][0].lang_pred == rows[i][2] for i in held) >= 0.98 * len(held)
    assert [(found[i][0].lang_pred, found[i][0].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert found[1003][0].lang_pred == "aa" and found[None][0].lang_pred == rows[0][2]
    assert all(len({(x.lang_pred, round(x.score, 5)) for x in found[i]}) == 1 and len(found[i]) == 2 for i in range(5))


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    rows = corpus(150)
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows]
    first = {x.doc_id: x for x in la.predicted(table(spark, rows)).collect()}
    turned = [(i, t, "bb" if h else x) for (i, t, x), h in zip(rows, held)]
    second = {x.doc_id: x for x in la.predicted(table(spark, turned).repartition(2)).collect()}
    assert all(first[i].lang_pred == second[i].lang_pred and abs(first[i].score - second[i].score) < 1e-4 for i in first)


@pytest.mark.parametrize("rows,want", [([], []), ([(1, "a b", None)], [(1, "und", 0.0)]), ([(1, "a b", "xx"), (2, "zz", None), (3, "1", None)],
                                                                                         [(1, "xx", 1.0), (2, "xx", 1.0), (3, "und", 0.0)])])
def test_little_to_learn_from(spark, rows, want):
    assert sorted((x.doc_id, x.lang_pred, x.score) for x in la.predicted(table(spark, rows)).collect()) == want


def test_sample_is_bounded_and_even(spark):
    rows = corpus(400)
    model = la.fit(table(spark, rows), sample=30)
    assert model.languages == ["aa", "bb", "cc"] and model.landmarks.matrix.shape[1] == 30
    assert {model.predict([t])[0][0] == x for _, t, x in rows if len(t) > 100} == {True}
