import pytest

from tarn.llm import licences as li


@pytest.fixture(scope="module")
def model(spark):
    return li.train(spark)


def test_held_out_examples(spark, model):
    rows = li.examples(spark).filter("held")
    got = model.predict(rows.withColumnRenamed("family", "true")).select("true", "family").toPandas()
    known = got[got["true"] != li.UNKNOWN]
    assert (known["true"] == known["family"]).mean() > 0.9
    assert (got[got["true"] == li.UNKNOWN]["family"] != li.UNKNOWN).mean() <= 0.02
    assert 0.5 <= model.threshold < 0.99


def test_statements_and_clean_texts(spark, model):
    rows = [(1, "Some text here.\nReleased under the MIT License.\nmore"), (2, "x\nLicensed under CC BY-NC 4.0."), (3, "Licensed under the Apache License, Version 2.0."),
            (4, "This work is licensed under the GNU General Public License, version 3."), (5, "He lost his driver license in the rights debate."),
            (6, "This file is free: licensed\nunder the Apache License, Version 2.0 and nothing else"), (7, None), (8, ""), (9, "nothing at all"),
            (10, "Released under the MIT License.\nReleased under the MIT License.\nLicensed under CC BY 4.0."), (11, "The licence office grants permission to all commons."),
            (None, "Released under the MIT License."), (1, "Some text here.\nReleased under the MIT License.\nmore"), (12, "word " * 30000 + "\nSPDX-License-Identifier: MPL-2.0")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, family string, row_id int")
    got = sorted(((r.doc_id, r.licence, r.n_statements, ",".join(r.families)) for r in li.scan(df, model).collect()), key=str)
    want = [(1, "MIT", 1, "MIT"), (1, "MIT", 1, "MIT"), (2, "CC-BY-NC", 1, "CC-BY-NC"), (3, "Apache-2.0", 1, "Apache-2.0"), (4, "GPL", 1, "GPL"), (5, None, 0, ""),
            (6, "Apache-2.0", 1, "Apache-2.0"), (7, None, 0, ""), (8, None, 0, ""), (9, None, 0, ""), (10, "MIT", 3, "CC-BY,MIT"), (11, None, 0, ""),
            (12, "MPL-2.0", 1, "MPL-2.0"), (None, "MIT", 1, "MIT")]
    assert got == sorted(want, key=str)


def test_whole_table_against_plain_search(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id for r in li.scan(docs, model).collect() if r.licence}
    assert got == {r.doc_id for r in docs.filter("text rlike '(?i)licensed under|released under|all rights reserved'").collect()}


def test_empty_table(spark, model):
    assert li.scan(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []


def test_short_and_wrapped_notices(spark, model):
    cases = [("MIT License", "MIT", 1), ("License: MIT", "MIT", 1), ("Licensed under MIT.", "MIT", 1), ("BSD licence", "BSD", 1), ("License: GPLv3", "GPL", 1), ("CC BY-NC", "CC-BY-NC", 1),
             ("All rights reserved", "Proprietary", 1), ("Apache License", "Apache-2.0", 1), ("Released under the\nMIT License.", "MIT", 1), ("Licensed\r\nunder the Apache  \nLicense, Version 2.0.", "Apache-2.0", 1),
             ("My Project\nThis work is licensed under the\nGNU\nGeneral Public License, version 3.\nEnd", "GPL", 1), ("License:\nMIT", "MIT", 1), ("MIT License\nMIT License", "MIT", 2),
             ("Driver License", None, 0), ("License: unknown", None, 0), ("Licensed under", None, 0), ("The fishing\nLicence costs ten pounds.", None, 0), ("Apache helicopters", None, 0), ("License plate\nMIT", None, 0)]
    docs = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: (r.licence, r.n_statements) for r in li.scan(docs, model).collect()}
    assert {c[0]: got[i] for i, c in enumerate(cases)} == {c[0]: c[1:] for c in cases}
