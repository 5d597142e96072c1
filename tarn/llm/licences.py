"""Licence statements: a trained paragraph classifier, a calibrated unknown class, and a comparison with templates.

All of it runs in Spark's own operators and MLlib. Features are the one- to three-word sequences that hold a telling word
(``TELLING``), so a paragraph without one has no features and is unknown; a text without one is not even split.
The multinomial logistic regression is trained on the templates, thinned and embedded by seeded hashes, and on paragraphs that use
telling words for other things. Its threshold for "unknown" is set on examples kept out of training. A prediction counts only if
enough of a template of that family is found in the paragraph.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm.common import row_keys, stored

UNKNOWN = "unknown"
SLOTS = 1 << 14
COPIES = 12
SHARE = 0.6
JOINT = "\x01"  # between lines that were joined; no part of a word
#: fixed values: words that licence statements use and other paragraphs seldom do
TELLING = ("licence license licensed licenses licensing licenced copyright copyrighted spdx bsd apache gnu gpl lgpl agpl affero lesser mozilla mpl "
           "creative commons cc cc0 unlicense isc eclipse epl boost warranty warranties merchantability redistribution redistributions "
           "permission granted rights reserved patent noncommercial attribution sharealike dedicated waived proprietary confidential").split()
#: fixed values: usual wordings of the public licences' notices
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT", "This project is licensed under the terms of the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0", "Released under the Apache 2.0 license.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "BSD": ["Released under the BSD License.", "Licensed under the 3-clause BSD license.", "SPDX-License-Identifier: BSD-3-Clause", "SPDX-License-Identifier: BSD-2-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU GPL v3.", "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-2.0-only", "Released under the GPL.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
            "You should have received a copy of the GNU General Public License along with this program."],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-2.1-or-later", "Released under the LGPL license.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only", "Released under the AGPL license.",
             "redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "MPL-2.0": ["Licensed under the Mozilla Public License, Version 2.0.", "SPDX-License-Identifier: MPL-2.0", "Released under the MPL 2.0 license.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "EPL-2.0": ["Licensed under the Eclipse Public License, version 2.0.", "SPDX-License-Identifier: EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "ISC": ["Released under the ISC License.", "SPDX-License-Identifier: ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "CC0": ["Dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0", "Licensed under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "CC-BY": ["Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "This article is distributed under the terms of the Creative Commons Attribution License"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Text is available under the Creative Commons Attribution-ShareAlike License"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Shared under a Creative Commons Attribution NonCommercial license"],
    "Unlicense": ["This is free and unencumbered software released into the public domain under the Unlicense.", "SPDX-License-Identifier: Unlicense", "Released under the Unlicense."],
    "Proprietary": ["Copyright 2024 Example Corporation. All rights reserved.", "All rights reserved.", "This software is proprietary and confidential. Unauthorized copying is strictly prohibited."],
}
#: fixed values: names and ids by which short notices call the licences
NAMES = {
    "MIT": ["MIT"], "Apache-2.0": ["Apache", "Apache 2.0", "Apache 2", "Apache-2.0"], "BSD": ["BSD", "BSD-3-Clause", "BSD-2-Clause", "New BSD", "Simplified BSD"],
    "GPL": ["GPL", "GNU GPL", "GPLv3", "GPLv2", "GPL v3", "GPL-3.0"], "LGPL": ["LGPL", "GNU LGPL", "LGPLv3", "LGPL-2.1"], "AGPL": ["AGPL", "GNU AGPL", "AGPLv3", "AGPL-3.0"],
    "MPL-2.0": ["MPL", "MPL 2.0", "MPL-2.0", "Mozilla Public"], "EPL-2.0": ["EPL", "EPL 2.0", "EPL-2.0", "Eclipse Public"], "ISC": ["ISC"], "CC0": ["CC0", "CC0 1.0"],
    "CC-BY": ["CC BY", "CC BY 4.0"], "CC-BY-SA": ["CC BY-SA", "CC BY-SA 4.0"], "CC-BY-NC": ["CC BY-NC", "CC BY-NC 4.0"], "Unlicense": ["Unlicense"],
}
#: short notices of a name, and such as stand without the word licence
NOTICES = ["{} License", "{} Licence", "License: {}", "Licence: {}", "Licensed under {}", "Released under {}", "{} licensed", "The {} License", "Under the {} License"]
SHORT = {f: [n.format(x) for x in xs for n in NOTICES] for f, xs in NAMES.items()}
SHORT["GPL"] += ["GNU General Public License", "General Public License"]
SHORT["Proprietary"] = ["All rights reserved", "Proprietary and confidential"]
BARE = {"CC0": ["CC0 1.0"], "CC-BY": ["CC BY"], "CC-BY-SA": ["CC BY-SA"], "CC-BY-NC": ["CC BY-NC"]}
#: paragraphs that use telling words for something else
OTHERS = ["She had to renew her driver license before the trip.", "The fishing licence costs ten pounds a year.", "Permission was granted by the council last week.", "The apache helicopters landed at dawn.",
          "Creative writing is taught on Mondays.", "The house of commons voted against the bill.", "The boost in sales was a surprise.", "A solar eclipse can be seen in May.", "The warranty of the washing machine has expired.",
          "Seats are reserved for members.", "She studied physics at MIT and moved to Boston.", "The gnu is a large antelope of the savanna.", "He is the lesser known brother.", "A patent was filed for the new engine.",
          "Human rights were discussed at length.", "He was dedicated to his garden.", "The fee was waived for students.", "This letter is confidential.", "Attribution of the painting is uncertain.", "The licensing office opens at nine.",
          "The bar lost its license to sell alcohol.", "Copyright law changed in the last century.", "The redistribution of income was debated.", "Please send one cc to the office.", "Permission denied while opening the file.",
          "The sa and nc columns are empty.", "The commons were grazed by sheep.", "Mozilla held a conference.", "They signed a licence agreement with the band.", "The right to copyright expires.", "All seats reserved.", "The granted wish came true.",
          "Driver license", "Fishing licence", "License agreement", "License plate", "Licensed under", "License number", "License: see below"]
_FILLER = ("the of and to in that was on with it at as from this were we results then more people between house water field time year group small"
           " found made given light after many").split()


def telling_pattern() -> str:
    return "(?i)(?<![a-z0-9])(" + "|".join(TELLING) + ")(?![a-z0-9])"


def tokens(text: str | Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def sequences(words: str) -> Column:
    """One- to three-word sequences that hold a telling word; ``words`` names a column, so each is a look into it."""
    told = F.transform(F.col(words), lambda w, i: F.when(w.isin(TELLING), i + 1))
    windows = [(n, back) for n in (1, 2, 3) for back in range(n)]
    around = F.transform(F.filter(told, lambda p: p.isNotNull()),
                         lambda p: F.array(*[F.struct((p - back).alias("first"), F.lit(n).alias("n")) for n, back in windows]))
    inside = F.filter(F.flatten(around), lambda s: (s["first"] >= 1) & (s["first"] + s["n"] - 1 <= F.size(words)))
    return F.array_distinct(F.transform(inside, lambda s: F.array_join(F.slice(F.col(words), s["first"], s["n"]), " ")))


def with_sequences(lines: DataFrame) -> DataFrame:
    return lines.withColumn("_words", tokens("line")).withColumn("_features", sequences("_words")).drop("_words")


def _lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"(?<![.!?:;\n])\r?\n(?=[a-z(])", " "), r"\r?\n")


def paragraphs(docs: DataFrame, text: str = "text", position: str = "paragraph") -> DataFrame:
    """One row per line of a text, after joining lines that are wrapped within a sentence. Only texts and lines with a telling word."""
    rows = docs.filter(F.col(text).rlike(telling_pattern())).select(*[c for c in docs.columns if c != text], F.posexplode(_lines(F.col(text))).alias(position, "line"))
    return rows.filter(F.col("line").rlike(telling_pattern()))


def examples(spark: SparkSession) -> DataFrame:
    """(family, line, held): every template and every other paragraph ``COPIES`` times, with words dropped and other words around."""
    rows = [(family, t) for source in (TEMPLATES, SHORT, BARE) for family, ts in source.items() for t in ts] + [(UNKNOWN, t) for t in OTHERS] * 2
    base = spark.createDataFrame(rows, "family string, template string").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    draw = lambda *c: F.pmod(F.xxhash64("template", "copy", *c), F.lit(1000))
    words = F.split("template", " ")
    thinned = F.filter(words, lambda w, i: (F.col("copy") < 3) | (F.size(words) < 6) | (draw(w, i) >= 60))
    filler = F.array(*[F.lit(w) for w in _FILLER])
    around = lambda side: F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: F.element_at(filler, (draw(F.lit(side), i) % len(_FILLER) + 1).cast("int")))
    line = F.when(F.col("copy") % 3 == 2, F.concat(around("left"), thinned, around("right"))).otherwise(thinned)
    return base.select("family", F.array_join(line, " ").alias("line"), (draw(F.lit("held")) < 250).alias("held"))


class LicenceModel:
    def __init__(self, pipeline: PipelineModel, families: list[str], threshold: float):
        self.pipeline, self.families, self.threshold = pipeline, families, threshold

    def predict(self, lines: DataFrame) -> DataFrame:
        """``lines`` (with a column line) plus family, probability; below the threshold the family is unknown."""
        out = self.pipeline.transform(with_sequences(lines))
        chance = vector_to_array("_probability")
        names = F.array(*[F.lit(f) for f in self.families])
        out = out.withColumn("probability", F.array_max(chance)).withColumn("family", F.element_at(names, F.array_position(chance, F.array_max(chance)).cast("int")))
        sure = (F.col("probability") >= self.threshold) & (F.size("_features") > 0)
        return out.withColumn("family", F.when(sure, F.col("family")).otherwise(F.lit(UNKNOWN))).drop("_features", "_hashed", "_raw", "_probability", "_prediction")


def train(spark: SparkSession) -> LicenceModel:
    """Fit on the examples and set the unknown threshold so that at most one in a hundred held-out other paragraphs passes."""
    rows = stored(examples(spark).coalesce(1), "licence-examples")
    index = StringIndexer(inputCol="family", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    hashing = HashingTF(numFeatures=SLOTS, binary=True, inputCol="_features", outputCol="_hashed")
    # every family weighs the same, so that the many other paragraphs don't outweigh a family's few wordings
    sizes = rows.groupBy("family").agg((100.0 / F.count(F.lit(1))).alias("weight"))
    fit_rows = hashing.transform(with_sequences(index.transform(rows.filter("NOT held").join(F.broadcast(sizes), "family"))))
    model = LogisticRegression(featuresCol="_hashed", labelCol="label", weightCol="weight", maxIter=50, regParam=0.0005, probabilityCol="_probability",
                               rawPredictionCol="_raw", predictionCol="_prediction").fit(fit_rows)
    out = LicenceModel(PipelineModel([hashing, model]), list(index.labels), 0.0)
    wrong = out.predict(rows.filter(F.col("held") & (F.col("family") == UNKNOWN)).select("line")).filter(F.col("family") != UNKNOWN)
    others = rows.filter(F.col("held") & (F.col("family") == UNKNOWN)).count()
    highest = [r["probability"] for r in wrong.orderBy(F.desc("probability")).limit(others // 100 + 1).collect()]
    out.threshold = max(0.5, highest[-1] + 1e-6 if len(highest) > others // 100 else 0.0)
    return out


def _pairs(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b)))


def confirm(lines: DataFrame, share: float = SHARE) -> DataFrame:
    """Keep predictions of which a template of the family shares at least ``share`` of the template's or the line's word pairs (of at least three).

    A line of fewer pairs is compared with the family's short notices by the shorter side, and must hold a whole name of it."""
    spark = lines.sparkSession
    sources = [(TEMPLATES, False), (SHORT, True), (BARE, True)]
    known = spark.createDataFrame([(f, short, t) for source, short in sources for f, ts in source.items() for t in ts], "family string, short boolean, template string")
    known = known.groupBy("family").agg(F.collect_list(F.when(~F.col("short"), _pairs(tokens("template")))).alias("_templates"),
                                        F.collect_list(F.when(F.col("short"), _pairs(tokens("template")))).alias("_notices"))
    names = [(f, x) for f, xs in NAMES.items() for x in xs] + [("GPL", "General Public"), ("Proprietary", "rights reserved"), ("Proprietary", "proprietary and confidential")]
    named = spark.createDataFrame(names, "family string, name string").groupBy("family").agg(
        F.collect_list(F.concat(F.lit(" "), F.array_join(tokens("name"), " "), F.lit(" "))).alias("_names"))
    near = lines.filter(F.col("family") != UNKNOWN).join(F.broadcast(known.join(named, "family")), "family").withColumn("_tokens", tokens("line"))
    near = near.withColumn("_own", _pairs(F.col("_tokens")))
    near = near.withColumn("_near", F.when(F.size("_own") >= 3, F.col("_templates")).when(
        F.exists("_names", lambda n: F.contains(F.concat(F.lit(" "), F.array_join("_tokens", " "), F.lit(" ")), n)), F.concat("_templates", "_notices")))
    overlap = F.transform("_near", lambda t: F.size(F.array_intersect(t, F.col("_own"))) / F.greatest(F.lit(1), F.least(F.size(t), F.size("_own"))))
    return near.withColumn("similarity", F.array_max(overlap)).filter(F.col("similarity") >= share).drop("_templates", "_notices", "_names", "_tokens", "_own", "_near")


def wrapped(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Lines (with a telling word) that arise by joining each line without end punctuation to the next, whatever its first letter.

    Lines of ``found`` (row_id, row_hash, paragraph) are statements already and stay out, so none counts twice."""
    done = found.groupBy("row_id", "row_hash").agg(F.collect_set("paragraph").alias("_done"))
    lines = F.transform(_lines(F.col("text")), lambda x, i: F.when(F.array_contains(F.coalesce("_done", F.array().cast("array<int>")), i), F.lit("")).otherwise(F.rtrim(x)))
    joined = F.regexp_replace(F.array_join(lines, "\n"), r"(?<![.!?;\n])\n(?=[^\n])", JOINT)
    rows = texts.join(done, ["row_id", "row_hash"], "left").select("row_id", "row_hash", F.explode(F.split(joined, "\n")).alias("line"))
    return rows.filter(F.contains("line", F.lit(JOINT)) & F.col("line").rlike(telling_pattern()))


def scan(docs: DataFrame, model: LicenceModel | None = None) -> DataFrame:
    """(doc_id, n_statements, families, licence, probability), one row for each row of ``docs``.

    families lists the distinct licence families of the confirmed lines in order, licence is the one with most lines (the
    first in order among equals), probability its best; null where no line is confirmed. Null and empty texts have
    none. Rows with null ids and repeated rows keep their own row; other columns are ignored.
    """
    model = model or train(docs.sparkSession)
    keyed = docs.select("doc_id", *row_keys(), "text")
    texts = keyed.filter(F.col("text").rlike(telling_pattern())).select("row_id", "row_hash", "text").dropDuplicates(["row_id", "row_hash"])
    found = stored(confirm(model.predict(paragraphs(texts))).select("row_id", "row_hash", "paragraph", "family", "probability"), "licence-lines")
    more = confirm(model.predict(wrapped(texts, found)))
    found = found.drop("paragraph").unionByName(more.select("row_id", "row_hash", "family", "probability"))
    per_family = found.groupBy("row_id", "row_hash", "family").agg(F.count(F.lit(1)).alias("n"), F.max("probability").alias("p"))
    per_row = per_family.groupBy("row_id", "row_hash").agg(F.sum("n").alias("n_statements"), F.array_sort(F.collect_list("family")).alias("families"),
                                                           F.min(F.struct((-F.col("n")).alias("n"), "family", "p")).alias("first"))
    per_row = stored(per_row, "licences")
    return keyed.select("doc_id", "row_id", "row_hash").join(per_row, ["row_id", "row_hash"], "left").select(
        "doc_id", F.coalesce("n_statements", F.lit(0)).cast("long").alias("n_statements"), F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.col("first.family").alias("licence"), F.col("first.p").alias("probability"))
