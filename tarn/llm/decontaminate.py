"""Benchmark decontamination: a broadcast hash set of test word windows, scanned against every training window.

The test windows of one pass are bounded (``WINDOWS_PER_PASS``, ``BYTES_PER_PASS``), so what is broadcast never grows with the
benchmark: a larger benchmark is dealt into blocks by window hash and the texts are scanned once per block.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import map_batches, passing_columns, row_keys, stored
from tarn.llm.kernels import LOWER, PIECE, batches_of, chained_names, join_texts, prefix_names, substring_names, word_bounds

WINDOW = 10
WINDOWS_PER_PASS = 200_000
BYTES_PER_PASS = 32 << 20
#: everything below U+0080 that is neither a digit nor a lower-case letter
SEPARATORS = np.array([b < 0x80 and not (48 <= b <= 57 or 97 <= b <= 122) for b in range(256)])


def _words(bodies: list[bytes | None]):
    """Bytes, word starts and ends, word names, and the first word of each text."""
    data, offsets = join_texts([(b or b"").translate(LOWER) for b in bodies])
    starts, ends = word_bounds(data, SEPARATORS)
    return data, starts, ends, substring_names(prefix_names(data), starts, ends), np.searchsorted(starts, offsets)


def _item_windows(window: int):
    def run(batch: pa.RecordBatch):
        data, starts, ends, names, first = _words(batch.column("body").to_pylist())
        out: list[tuple] = []
        for item, a, b in zip(batch.column("item_id").to_pylist(), first[:-1], first[1:]):
            n = min(window, b - a)
            if n:
                for i, name in enumerate(chained_names(names[a:b], n)):
                    text = b" ".join(data[s:e].tobytes() for s, e in zip(starts[a + i:a + i + n], ends[a + i:a + i + n]))
                    out.append((int(name.view(np.int64)), int(n), text, item))
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in
                                          enumerate((pa.int64(), pa.int32(), pa.binary(), batch.column("item_id").type))],
                                         names=["name", "n", "window", "item_id"])

    return run


def _scan(handle):
    state: dict = {}

    def run(batch: pa.RecordBatch):
        if not state:
            by_length: dict[int, dict] = defaultdict(lambda: defaultdict(list))
            for name, n, text, items in handle.value:
                by_length[n][name].append((text, items))
            state["names"] = {n: np.sort(np.fromiter(d, np.int64, len(d))) for n, d in by_length.items()}
            state["windows"] = {n: dict(d) for n, d in by_length.items()}
        bodies = batch.column("body").to_pylist()
        counts, hits, items = [], [], []
        for part in batches_of([len(b or b"") for b in bodies], PIECE):
            data, starts, ends, words, first = _words(bodies[part])
            found: dict[int, list] = defaultdict(list)
            for n, known in state["names"].items():
                names = chained_names(words, n).view(np.int64)
                if not len(names):
                    continue
                at = np.minimum(np.searchsorted(known, names), len(known) - 1)
                for w in np.flatnonzero(known[at] == names):
                    text = np.searchsorted(first, w, "right") - 1
                    if w + n > first[text + 1]:
                        continue  # reaches into the next text
                    own = b" ".join(data[s:e].tobytes() for s, e in zip(starts[w:w + n], ends[w:w + n]))
                    for window, ids in state["windows"][n][int(names[w])]:
                        if window == own:
                            found[text].append((w - first[text], w - first[text] + n, ids))
            for t in range(len(first) - 1):
                counts.append(int(first[t + 1] - first[t]))
                hits.append([{"low": int(a), "high": int(b)} for a, b, _ in found.get(t, ())])
                items.append(sorted({i for _, _, ids in found.get(t, ()) for i in ids}))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), batch.column("row_hash"), batch.column("doc_id"), pa.array(counts, pa.int64()),
             pa.array(hits, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))), pa.array(items, pa.list_(pa.string()))],
            names=["row_id", "row_hash", "doc_id", "n_words", "spans", "items"])

    return run


def _merged(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["low"], s["high"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _summed(batch: pa.RecordBatch):
    spans = [_merged(x) for x in batch.column("spans").to_pylist()]
    items = [sorted(set(x)) for x in batch.column("items").to_pylist()]
    yield pa.RecordBatch.from_arrays(
        [*[batch.column(c) for c in ("row_id", "row_hash", "doc_id", "n_words")], pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
         pa.array([[{"low": a, "high": b} for a, b in s] for s in spans], pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))),
         pa.array([len(i) for i in items], pa.int64()), pa.array(items, pa.list_(pa.string())),
         pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items])],
        names=["row_id", "row_hash", "doc_id", "n_words", "n_hit", "spans", "n_items", "items", "items_sha256"])


def _passages(keyed: DataFrame, benchmark: DataFrame, window: int, per_pass: int) -> DataFrame:
    windows = stored(map_batches(benchmark.select("item_id", F.col("text").cast("binary").alias("body")), _item_windows(window),
                                 f"name long, n int, window binary, item_id {dict(benchmark.dtypes)['item_id']}")
                     .groupBy("name", "n", "window").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")), "windows")
    size = windows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("window")).alias("bytes")).first()
    passes = max(1, -(-size["n"] // per_pass), -(-(size["bytes"] or 0) // BYTES_PER_PASS))
    kind = dict(keyed.dtypes)["doc_id"]
    schema = f"row_id long, row_hash long, doc_id {kind}, n_words long, spans array<struct<low: int, high: int>>, items array<string>"
    summed = (f"row_id long, row_hash long, doc_id {kind}, n_words long, n_hit long, "
              "spans array<struct<low: int, high: int>>, n_items long, items array<string>, items_sha256 string")
    found = None
    for block in range(passes):
        own = windows.filter(F.pmod("name", F.lit(passes)) == block) if passes > 1 else windows
        rows = [(r["name"], r["n"], bytes(r["window"]), r["items"]) for r in own.collect()]
        scan = _scan(keyed.sparkSession.sparkContext.broadcast(rows))
        if passes == 1:  # a second step over the same rows would be a second worker process for each task, and workers live on
            return map_batches(keyed, lambda batch: (out for hits in scan(batch) for out in _summed(hits)), summed)
        hits = map_batches(keyed, scan, schema)
        found = hits if found is None else found.unionByName(hits)
    # each row of a repeated document was scanned once per block
    found = (found.groupBy("row_id", "row_hash").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
             F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"),
             (F.count(F.lit(1)) / passes).cast("int").alias("copies"))
             .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))
    return map_batches(found.select("row_id", "row_hash", "doc_id", "n_words", "spans", "items"), _summed, summed)


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, per_pass: int = WINDOWS_PER_PASS) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, n_items, items, items_sha256), one row for each row of ``docs``.

    Words are maximal runs of digits, letters and characters above U+007F after lower-casing A-Z. A window is ``window``
    consecutive words of an item, or all words of a shorter one; every occurrence in a text is found by its name and
    verified word by word. ``spans`` are the merged word ranges [low, high) of all occurrences. Null and empty texts
    have no words; null or empty items no windows; a null item_id is not reported, its words are still hit.
    Repeated rows are scanned each; other columns are ignored.
    """
    keyed = docs.select("doc_id", *row_keys(), F.col("text").cast("binary").alias("body"))
    return _passages(keyed, benchmark, window, per_pass).drop("row_id", "row_hash")


@passing_columns("doc_id", "text")
def remove_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, per_pass: int = WINDOWS_PER_PASS,
                    whole: bool = True) -> DataFrame:
    """``docs`` without contaminated documents, or (``whole=False``) with the hit words cut out of their texts.

    All columns of ``docs`` are kept; documents without hits are unchanged. Documents are matched by row, so nulls
    and repeated rows behave as in ``find_passages``.
    """
    row_id, row_hash = row_keys()
    keyed = docs.select("*", row_id.alias("_row_id"), row_hash.alias("_row_hash"))
    hit = (_passages(docs.select("doc_id", *row_keys(), F.col("text").cast("binary").alias("body")), benchmark, window, per_pass)
           .filter("n_hit > 0").select(F.col("row_id").alias("_row_id"), F.col("row_hash").alias("_row_hash"), F.col("spans").alias("_spans"))
           .dropDuplicates(["_row_id", "_row_hash"]))
    if whole:
        return keyed.join(hit, ["_row_id", "_row_hash"], "left_anti").select(*docs.columns)
    spans = keyed.join(hit, ["_row_id", "_row_hash"], "left")
    others = [c for c in docs.columns if c != "text"]

    def cut(batch: pa.RecordBatch):
        texts = []
        for body, ranges in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist()):
            if ranges:
                raw = body.encode()
                data, starts, ends, _, _ = _words([raw])
                at, parts = 0, []
                for r in ranges:
                    parts.append(raw[at:starts[r["low"]]])
                    at = int(ends[r["high"] - 1])
                body = b"".join([*parts, raw[at:]]).decode()
            texts.append(body)
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(texts, pa.string())], names=[*others, "text"])

    return map_batches(spans.select(*others, "text", "_spans"), cut, docs.select(*others, "text").schema).select(*docs.columns)
