import random
import zlib

import numpy as np

from tarn.llm import toxicity as t


def test_label_model_recovers_chances_and_correlations():
    r = np.random.default_rng(3)
    n = 6000
    y = r.random(n) < 0.15
    chances = [(0.02, 0.7), (0.05, 0.6), (0.01, 0.5), (0.1, 0.4), (0.02, 0.55)]
    votes = np.stack([r.random(n) < np.where(y, b, a) for a, b in chances], axis=1).astype(float)
    copy = np.where(r.random(n) < 0.9, votes[:, 4], r.random(n) < 0.05)  # agrees with its neighbour whatever the class
    votes = np.column_stack([votes, copy])
    start = votes[:, :3].mean(axis=1)
    model = t.fit_label_model(votes, start)
    assert np.abs(model.chances[:4] - np.array(chances[:4])).max() < 0.12
    assert model.correlations[4, 5] > 0.5 and abs(model.correlations[0, 1]) < 0.15
    assert model.weights[4] < 0.75 and model.weights[0] > 0.85
    found = model.posterior(votes)
    assert found[y].mean() > 0.7 and found[~y].mean() < 0.1


def documents(spark, n=900):
    r = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{chr(97 + r.randrange(26))}{chr(97 + r.randrange(26))}" for _ in range(r.randrange(20, 80))]
        toxic = i % 7 == 0
        if toxic:
            words[3] = r.choice(["idiot", "Blorgum", "blorgist", "zanker"])
            words[9] = r.choice(["blorgun", "zanker", "scum"])
        rows.append((i, " ".join(words), 1, 0.5))
        labels.append((i, int(toxic) if r.random() > 0.02 else int(not toxic)))
    return spark.createDataFrame(rows + [(None, "zanker idiot", 1, 0.5), (n, None, 1, 0.5), (n + 1, "", 1, 0.5)], "doc_id long, text string, toxic int, score double"), \
        spark.createDataFrame(labels + [(None, 1), (n, 1), (n + 5, 1), (3, None)], "doc_id long, toxic int")


def test_held_out_rows_are_found_and_not_learned_from(spark):
    docs, labels = documents(spark)
    got = {x.doc_id: x for x in t.scored(docs, labels).collect()}
    assert len(got) == 903
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held == sorted(i for i, x in got.items() if i is not None and i < 900 and x.held_out)
    right = sum((got[i].predicted == 1) == (i % 7 == 0) for i in held)
    assert right / len(held) > 0.95
    assert got[None].predicted == 1 and got[900].score == got[901].score and got[900].predicted == 0
    turned = labels.selectExpr("doc_id", "if(doc_id % 2 = 0 and crc32(string(doc_id)) % 4 = 2, 1 - toxic, toxic) as toxic")
    again = {x.doc_id: x.score for x in t.scored(docs.repartition(3), turned).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-9 for i in again)


def test_without_labels_or_rows(spark):
    docs, labels = documents(spark, 20)
    assert len({x.score for x in t.scored(docs, labels.limit(0)).collect()}) == 1
    assert t.scored(docs.limit(0), labels).collect() == []


def test_rare_toxic_words_among_many_frequent_neutral_ones(spark):
    r = random.Random(5)
    heads = [chr(97 + i // 576) + chr(97 + i // 24 % 24) + chr(97 + i % 24) + "q" for i in range(10_000)]
    neutral = " ".join(h + "".join(r.choice("abcdefgh") for _ in range(4)) for h in heads)  # 50,000 features in each text
    ids = [i for i in range(90) if zlib.crc32(str(i).encode()) % 4 != 2][:60]
    docs = spark.createDataFrame([(i, neutral + (" zanker" if k < 3 else "")) for k, i in enumerate(ids)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k < 6)) for k, i in enumerate(ids)], "doc_id long, toxic int")
    assert t.fit(docs, labels).weights[b"zanker"] > 0
