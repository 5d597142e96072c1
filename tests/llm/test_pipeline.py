import re
from collections import defaultdict

import corpus_pipeline as cp

from tarn.llm import mixing, quality
from tarn.llm.tokens import Encoder, word_bpe

D = "/root/testdata/sf0.01"


def test_stages_in_order_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    kept = [docs]
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, kept[-1], D).cache()
        assert out.columns == docs.columns, name
        kept.append(out)
    good, unique, clean, mix = ([(r.doc_id, r.text, r.source) for r in k.collect()] for k in kept[1:])

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
    judged = quality.judged(docs, spark.read.parquet(f"{D}/labels.parquet")).select("doc_id", "_base_failed", "_kept").collect()
    assert {d for d, _, _ in good} == {r.doc_id for r in judged if r["_kept"]}
    fine = [r.doc_id for r in judged if labels.get(r.doc_id) == 1 and not r["_base_failed"]]
    assert sum(d in {g[0] for g in good} for d in fine) > 0.95 * len(fine)

    sets = {d: set(zip(*[(t.lower().split())[i:] for i in range(5)])) for d, t, _ in good}
    alive = {d for d, _, _ in unique}
    holders = defaultdict(list)
    for d in sorted(sets):
        for x in sets[d]:
            holders[x].append(d)
    meet = {(d, e) for ds in holders.values() for i, d in enumerate(ds) for e in ds[i + 1:]}
    linked = [(d, e) for d, e in meet if 5 * len(sets[d] & sets[e]) >= 4 * len(sets[d] | sets[e])]
    assert not any(d in alive and e in alive for d, e in linked)
    gone = set(sets) - alive
    up = {d: d for d in sets}
    for a, b in linked:
        while up[a] != a:
            a = up[a]
        while up[b] != b:
            b = up[b]
        up[max(a, b)] = min(a, b)
    assert gone == {d for d in sets if up[d] != d}

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for r in spark.read.parquet(f"{D}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9)) if w}
    bad = {d for d, t, _ in unique if any(tuple(words(t)[i:i + 10]) in windows for i in range(len(words(t))))}
    assert {d for d, _, _ in clean} == alive - bad and bad

    taken, sizes = defaultdict(int), defaultdict(int)
    for d, t, s in clean:
        sizes[s] += len(t.split())
    for d, t, s in mix:
        taken[s] += len(t.split())
    target = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert all(abs(taken[s] - target[s]) < 0.05 * target[s] for s in sizes)

    index = cp.STAGES[-1][1](spark, kept[-1], D).orderBy("start").collect()
    e = Encoder(word_bpe()).tokenizer
    assert sorted(r.n_tokens for r in index) == sorted(len(x.ids) + 1 for x in e.encode_batch([t for _, t, _ in mix], add_special_tokens=False))
    at = 0
    for r in index:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in index] == sorted(r.doc_id for r in index)


def test_run_is_the_stages_one_after_another(spark):
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0


def test_tasks_hold_little_of_their_input(spark):
    """Batches of long texts are cut by bytes, and arrays are made of a small piece of a batch at a time."""
    import tracemalloc

    import pyarrow as pa

    from tarn.llm import kernels, setsketch
    from tarn.llm.common import map_batches

    def bytes_of(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]})

    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 1500) AS text")
    passed = map_batches(docs, lambda b: iter([b]), docs.schema)
    for df in (passed, quality.with_counts(docs).select("doc_id", "text")):
        got = df.mapInArrow(bytes_of, "n long, size long").collect()
        assert sum(r.n for r in got) == 3000 and max(r.size for r in got) < 10 << 20

    texts = [" ".join(f"w{i * j % 977}" for j in range(2000)).encode() for i in range(200)]
    for work in (lambda: setsketch.shingle_sets(texts, 5), lambda: quality.text_counts(texts)):
        kernels._POWERS.clear()
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 24 << 20
