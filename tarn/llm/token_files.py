"""Token ids as ORC files: run-length encoded integers, row indexes, Bloom filters on document ids, stripe-parallel reads."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm.common import map_batches, slices
from tarn.llm.tokens import encoder
from tarn.session import small_batches

END = 2
ORC = {"orc.compress": "ZSTD", "orc.stripe.size": str(16 << 20), "orc.row.index.stride": "2000", "orc.create.index": "true",
       "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}


def _encoded(tokenizer: str, end: int):
    def run(batches):
        at = 0
        tail = np.array([end], "<u4").tobytes()
        for batch in (piece for whole in batches for piece in slices(whole)):
            ids = [x + tail for x in encoder(tokenizer).encode(batch.column("body").to_pylist())]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            ends = np.concatenate(([0], np.cumsum(n)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(n), TaskContext.get().partitionId(), np.int32)),
                 pa.array(at + ends[:-1]), pa.array(n),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), "<u4").view(np.int32)))],
                names=["doc_id", "shard", "place", "n_tokens", "ids"])
            at += int(ends[-1])
        pa.default_memory_pool().release_unused()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = END) -> None:
    """Write (doc_id, shard, place, n_tokens, ids) in ascending order of doc_id; ``shard`` numbers the files, ``place`` is the
    number of ids before the document in its file.

    Every text is encoded whole and followed by the id ``end``; a null or empty text is that id alone. Null doc_ids
    come first; rows with the same doc_id are ordered by their text's hash, and repeated rows are written each. Texts
    are dealt by ranges of (doc_id, hash), so many rows of one id still spread. Other columns are ignored.
    """
    ordered = (docs.select("doc_id", F.col("text").cast("binary").alias("body"), F.xxhash64("text").alias("row_hash"))
               .repartitionByRange("doc_id", "row_hash").sortWithinPartitions("doc_id", "row_hash").select("doc_id", "body"))
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, shard int, place long, n_tokens long, ids array<int>"
    small_batches(docs.sparkSession)
    ordered.mapInArrow(_encoded(tokenizer, end), schema).write.options(**ORC).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files again, one task per group of stripes; filters on doc_id skip files, stripes and row groups."""
    return spark.read.orc(path)  # with the type of doc_id that was written


def _checksums(batch: pa.RecordBatch):
    lists = batch.column("ids")
    flat, ends = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
    yield pa.RecordBatch.from_arrays(
        [*[batch.column(c) for c in ("doc_id", "shard", "place")], pa.array(np.diff(ends).astype(np.int64)),
         pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])], pa.int64())],
        names=["doc_id", "shard", "place", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read from the files; ``start`` counts the ids of all documents before."""
    tokens = read_tokens(spark, path)
    rows = map_batches(tokens, _checksums, f"doc_id {dict(tokens.dtypes)['doc_id']}, shard int, place long, n_tokens long, ids_crc32 long")
    # a row per file: file sizes summed before the window, which then holds one row per file
    from pyspark.sql import Window

    totals = tokens.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"))
    return rows.join(before, "shard").select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
