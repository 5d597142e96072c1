"""Repeated byte strings by prefix doubling over every position of a corpus.

A position is ranked by its first 8 bytes, then by pairs of ranks: the rank of twice the length comes from the rank here and
the rank at that distance. Spark sorts the pairs that occur more than once and numbers them in order; positions of
unique pairs leave, and with them every string that contains them. The last pair overlaps, so ranks end at exactly the
wanted length. Nothing is hashed, so the result is exact; the first step has one row for each byte of the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import map_batches, stored

FIRST = 8
PIECE = 1 << 18
_KEYS = ["row_id", "row_hash"]


def _first_bytes(batch: pa.RecordBatch):
    for row_id, row_hash, copies, body in zip(*(batch.column(c).to_pylist() for c in ("row_id", "row_hash", "copies", "body"))):
        data = np.frombuffer(body or b"", np.uint8)
        for at in range(0, len(data) - FIRST + 1, PIECE):
            piece = data[at:at + PIECE + FIRST - 1]
            n = len(piece) - FIRST + 1
            names = np.lib.stride_tricks.sliding_window_view(piece, FIRST)
            names = np.ascontiguousarray(names).view(">i8")[:, 0].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, row_id, np.int64)), pa.array(np.full(n, row_hash, np.int64)), pa.array(np.full(n, copies, np.int64)),
                 pa.array(np.arange(at, at + n, dtype=np.int32)), pa.array(names)], names=[*_KEYS, "copies", "place", "name"])


def _rerank(rows: DataFrame, by: list[str], step: int) -> DataFrame:
    """Rows whose ``by`` occurs again, with its number in sorted order."""
    again = rows.groupBy(*by).agg(F.sum("copies").alias("n")).filter("n > 1").select(*by)
    ranks = stored(again.orderBy(*by).withColumn("new", F.monotonically_increasing_id()), f"ranks-{step}")
    return stored(rows.join(ranks, by).select(*_KEYS, "copies", "place", F.col("new").alias("rank")), f"ranked-{step}")


def spans_by_doubling(keyed: DataFrame, length: int) -> DataFrame:
    """As ``substrings.repeated_spans``: spans (row_id, row_hash, low, high) of all strings of ``length`` bytes (16 or more) that start at
    two or more positions. Rows that share their keys are copies of one text."""
    if length < 2 * FIRST:
        raise ValueError("the length must be at least 16")
    texts = keyed.groupBy(*_KEYS).agg(F.first("body").alias("body"), F.count(F.lit(1)).alias("copies"))
    rows = stored(map_batches(texts, _first_bytes, "row_id long, row_hash long, copies long, place int, name long"), "positions")
    ranked, known = _rerank(rows, ["name"], FIRST), FIRST
    while known < length:
        ahead = min(known, length - known)
        there = ranked.select(*_KEYS, (F.col("place") - ahead).alias("place"), F.col("rank").alias("ahead"))
        known += ahead
        ranked = _rerank(stored(ranked.join(there, [*_KEYS, "place"]), f"pairs-{known}"), ["rank", "ahead"], known)
    return ranked.select(*_KEYS, F.col("place").alias("low"), (F.col("place") + length).alias("high"))
