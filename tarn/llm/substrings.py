"""Exact removal of long byte strings that occur more than once in a corpus, by refinement of sampled prefixes.

Suffixes are told apart by growing prefixes: at each step Spark groups the rows of positions by a name of their prefix,
positions whose prefix is unique leave, and the rest go on with a longer prefix until it reaches the threshold. Names are
taken anew from the text at each step; ``doubling.py`` derives ranks from pairs of earlier ranks instead, over every position, with the
same result and far more rows. Two things keep this form affordable at corpus scale:

* A step looks at sampled positions. Every string of ``length`` bytes is represented by the least-hashed short string
  within its first ``width`` bytes. The choice depends on these bytes alone, so equal strings choose equal places, and
  it is enough to compare the chosen places by the ``length - width + 1`` bytes that follow them. Prefixes are 144, then
  384, then 400 bytes for widths 257, 17 and 1; at width 1 every position stands for itself and the result is exact
  apart from hash collisions.
* If the whole neighbourhood of a chosen place (all the strings it represents, with their offsets) occurs again, all
  of them are repeated and the place is done. Only edges of repeats go on to the next step.

Every removal is decided by two 64-bit names together: that of the prefix (from its two halves) and that of the neighbourhood. A collision
of the first alone only keeps a place longer than needed.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import map_batches, row_keys, stored
from tarn.llm.kernels import U64, batches_of, join_texts, mix, prefix_names, sliding_min, substring_names

LENGTH = 400
WIDTHS = (257, 17, 1)
SHORT = 32
SEGMENT = 1 << 20
_PLACE = U64((1 << 24) - 1)
_ROWS = "row_id long, row_hash long, place int, back int, least int, rank long, around long"


def _choose(texts: list[bytes], lows: list[np.ndarray], highs: list[np.ndarray], length: int, width: int):
    """Chosen places of a batch: text number, place, largest and smallest distance to the starts it stands for, rank, neighbourhood.

    ``lows``/``highs`` bound the starts of each text that are looked at (inclusive).
    """
    data, offsets = join_texts(texts)
    short = min(SHORT, length - width + 1)
    prefix = prefix_names(data)
    starts = np.concatenate([np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi)]) + o if len(lo) else np.zeros(0, np.int64)
                             for lo, hi, o in zip(lows, highs, offsets)])
    if not len(starts):
        return None
    if width == 1:
        place = starts
    else:
        at = np.arange(len(data) - short + 1)
        order = (substring_names(prefix, at, at + short) & ~_PLACE) | at.astype(U64)
        place = (sliding_min(order, width)[starts] & _PLACE).astype(np.int64)
    text = np.searchsorted(offsets, starts, "right") - 1
    cut = np.flatnonzero((np.diff(place) != 0) | (np.diff(starts) != 1) | (np.diff(text) != 0)) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(starts)])) - 1
    place, low, high = place[first], starts[first], starts[last]
    half = (length - width + 1) // 2
    rank = mix(substring_names(prefix, place, place + half) * U64(0x9FB21C651E98DF25)
               + substring_names(prefix, place + half, place + length - width + 1))
    back, least = place - low, place - high
    around = mix(substring_names(prefix, low, high + length) + back.astype(U64) * U64(0xA0761D6478BD642F)
                 + least.astype(U64) * U64(0xE7037ED1A0B428DB))
    return text[first], place - offsets[text[first]], back, least, rank, around


def _segments(ids, hashes, bodies, ranges, length):
    """Overlapping pieces of at most SEGMENT starts, so a very long text never needs more memory than a piece."""
    for i, body in enumerate(bodies):
        n = len(body or b"")
        wanted = ranges[i] if ranges is not None else ([(0, n - length)] if n >= length else [])
        for at in range(0, max(n - length + 1, 0), SEGMENT):
            own = [(max(a, at) - at, min(b, at + SEGMENT - 1) - at) for a, b in wanted if a < at + SEGMENT and b >= at]
            if own:
                yield ids[i], hashes[i], at, body[at: at + SEGMENT + length - 1], own


def _places(length: int, width: int):
    def run(batch: pa.RecordBatch):
        ids, hashes, bodies = (batch.column(c).to_pylist() for c in ("row_id", "row_hash", "body"))
        ranges = None
        if "ranges" in batch.schema.names:
            ranges = [sorted((r["low"], r["high"]) for r in x) for x in batch.column("ranges").to_pylist()]
        pieces = list(_segments(ids, hashes, bodies, ranges, length))
        for part in batches_of([len(p[3]) for p in pieces], SEGMENT):
            own = pieces[part]
            found = _choose([p[3] for p in own], [np.array([a for a, _ in p[4]]) for p in own],
                            [np.array([b for _, b in p[4]]) for p in own], length, width)
            if found is None:
                continue
            text, place, back, least, rank, around = found
            row_id, row_hash, base = (np.array([p[k] for p in own], np.int64)[text] for k in (0, 1, 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (row_id, row_hash, (base + place).astype(np.int32), back.astype(np.int32),
                                       least.astype(np.int32), rank.view(np.int64), around.view(np.int64))],
                names=["row_id", "row_hash", "place", "back", "least", "rank", "around"])

    return run


def repeated_spans(keyed: DataFrame, length: int = LENGTH, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """Spans (row_id, row_hash, low, high) that cover exactly the bytes of all strings of ``length`` bytes starting at two
    or more positions of the corpus. ``keyed`` has row_id, row_hash, body (binary)."""
    if widths[-1] != 1 or any(w >= length - 1 for w in widths):
        raise ValueError("widths must end with 1 and stay below the length")
    spans, todo = [], None
    for width in widths:
        source = keyed if todo is None else keyed.join(todo, ["row_id", "row_hash"])
        rows = stored(map_batches(source, _places(length, width), _ROWS), f"places-{width}")
        if width == 1:
            again = stored(rows.groupBy("rank", "around").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("rank", "around"), "classes-1")
            spans.append(rows.join(again, ["rank", "around"]))
            break
        classes = stored(rows.groupBy("rank").agg(F.count(F.lit(1)).alias("n"), F.min("around").alias("a"), F.max("around").alias("b"))
                         .filter("n > 1").select("rank", (F.col("a") == F.col("b")).alias("alike")), f"classes-{width}")
        alive = stored(rows.join(classes, "rank"), f"alive-{width}")
        mixed = alive.filter(~F.col("alike"))
        around = stored(mixed.groupBy("rank", "around").agg(F.count(F.lit(1)).alias("n"),
                        F.min(F.struct("row_id", "row_hash", "place", "back", "least")).alias("first")), f"around-{width}")
        spans += [alive.filter("alike"), mixed.join(around.filter("n > 1").select("rank", "around"), ["rank", "around"])]
        # edges, and one member of each finished neighbourhood that edges may meet
        todo = (around.select("first.*").groupBy("row_id", "row_hash")
                .agg(F.collect_list(F.struct((F.col("place") - F.col("back")).alias("low"),
                                             (F.col("place") - F.col("least")).alias("high"))).alias("ranges")))
    out = None
    for s in spans:
        s = s.select("row_id", "row_hash", (F.col("place") - F.col("back")).alias("low"),
                     (F.col("place") - F.col("least") + length).alias("high"))
        out = s if out is None else out.unionByName(s)
    return out


def _cut(batch: pa.RecordBatch):
    kept, spans = [], []
    for body, ranges in zip(batch.column("body").to_pylist(), batch.column("ranges").to_pylist()):
        runs: list[list[int]] = []
        for low, high in sorted((r["low"], r["high"]) for r in ranges or []):
            if runs and low <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], high)
            else:
                runs.append([low, high])
        parts, at = [], 0
        for low, high in runs:
            parts.append(body[at:low])
            at = high
        kept.append(b"".join([*parts, body[at:]]))
        spans.append([{"low": a, "high": b} for a, b in runs])
    yield pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array([len(b) for b in batch.column("body").to_pylist()], pa.int64()),
         pa.array(kept, pa.binary()), pa.array(spans, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())])))],
        names=["doc_id", "n_bytes", "kept", "spans"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, widths: tuple[int, ...] = WIDTHS,
                   find: Callable[[DataFrame, int], DataFrame] | None = None) -> DataFrame:
    """(doc_id, n_bytes, kept binary, spans array<struct<low, high>>), one row for each row of ``docs``.

    Every byte covered by a ``length``-byte string that also starts anywhere else, in the same text or another, is
    removed; strings are judged on the input. A null text is empty. Rows with a null doc_id and repeated rows count as
    texts of their own. Other columns are ignored. Spans are maximal runs of removed bytes. ``find`` may be another way to
    find the spans, such as ``doubling.spans_by_doubling``.
    """
    keyed = docs.select("doc_id", *row_keys(), F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    bodies = keyed.select("row_id", "row_hash", "body")
    found = ((find(bodies, length) if find else repeated_spans(bodies, length, widths))
             .groupBy("row_id", "row_hash").agg(F.collect_set(F.struct("low", "high")).alias("ranges")))
    joined = keyed.join(found, ["row_id", "row_hash"], "left").select("doc_id", "body", "ranges")
    return map_batches(joined, _cut, f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, kept binary, spans array<struct<low: int, high: int>>")
