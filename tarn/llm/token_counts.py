"""Token counts as delta-maintained rollups: signed changes update additive totals, and a batch counts once however often it runs.

A ledger folder holds one sub-folder per batch with that batch's sums per (source, language, tokenizer version). A batch is
committed when its writer has left ``_SUCCESS``; a repeated commit is skipped, and what an interrupted writer left is overwritten
and never read before. Totals are the sums over committed batches. ``compact`` folds batches into a snapshot that names them.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.llm.common import map_batches, row_keys
from tarn.llm.tokens import encoder

MARKUP = r"[#*$%&|<>]"
KEYS = ["source", "lang", "tokenizer"]
SUMS = ["n_docs", "n_tokens"]
SCHEMA = T.StructType([*[T.StructField(k, T.StringType()) for k in KEYS], *[T.StructField(s, T.LongType()) for s in SUMS]])


def token_lengths(docs: DataFrame, tokenizer: str, columns: dict[str, str]) -> DataFrame:
    """``docs`` without texts, with one count for each entry ``name: text column``; a null text has no tokens."""
    keep = [c for c in docs.columns if c not in columns.values()]
    kinds = dict(docs.dtypes)

    def run(batch: pa.RecordBatch):
        counts = [[len(ids) // 4 for ids in encoder(tokenizer).encode(batch.column(c).cast(pa.binary()).to_pylist())] for c in columns.values()]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *[pa.array(x, pa.int64()) for x in counts]], names=[*keep, *columns])

    return map_batches(docs, run, ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], *[f"`{n}` long" for n in columns]]), hold=True)


def inserts(rows: DataFrame) -> DataFrame:
    """Signed sums per row for new documents (source, lang, tokenizer, n_tokens)."""
    return rows.select(*KEYS, F.lit(1).cast("long").alias("n_docs"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"))


def deletes(rows: DataFrame) -> DataFrame:
    """The same documents taken out again, with the counts they were inserted with."""
    return inserts(rows).select(*KEYS, (-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))


def revisions(rows: DataFrame) -> DataFrame:
    """Counts that changed from ``old_tokens`` to ``n_tokens`` under the same keys."""
    change = F.coalesce("n_tokens", F.lit(0)) - F.coalesce("old_tokens", F.lit(0))
    return rows.select(*KEYS, F.lit(0).cast("long").alias("n_docs"), change.cast("long").alias("n_tokens"))


class Ledger:
    """Rollups in a shared folder. Null keys are groups of their own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _folders(self, kind: str) -> list[str]:
        top = self._fs_path(f"{self.path}/{kind}")
        if not self._fs.exists(top):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(top)]
        return sorted(n for n in names if self._fs.exists(self._fs_path(f"{self.path}/{kind}/{n}/_SUCCESS")))

    def committed(self) -> list[str]:
        """Ids of all batches that count, those of the snapshot included."""
        return sorted({*self._folders("batches"), *self._snapshot()[1]})

    def _snapshot(self) -> tuple[str | None, list[str]]:
        names = self._folders("snapshots")
        if not names:
            return None, []
        listed = self.spark.read.text(f"{self.path}/lists/{names[-1]}")
        return names[-1], [r["value"] for r in listed.collect()]

    def commit(self, batch: str, *changes: DataFrame) -> bool:
        """Add the signed ``changes`` as batch ``batch``; False if that batch has been committed before."""
        if not re.fullmatch(r"[A-Za-z0-9-]{1,100}", batch):
            raise ValueError("a batch id has letters, digits and dashes")
        if batch in self.committed():
            return False
        together = changes[0]
        for c in changes[1:]:
            together = together.unionByName(c)
        sums = together.groupBy(*KEYS).agg(*[F.sum(s).cast("long").alias(s) for s in SUMS]).filter("n_docs <> 0 OR n_tokens <> 0")
        sums.write.mode("overwrite").parquet(f"{self.path}/batches/{batch}")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over all committed batches; groups that came to nothing are left out."""
        return self._sums(*self._snapshot(), self._folders("batches"))

    def _sums(self, snapshot: str | None, inside: list[str], batches: list[str]) -> DataFrame:
        paths = [f"{self.path}/batches/{b}" for b in batches if b not in set(inside)]
        if snapshot:
            paths.append(f"{self.path}/snapshots/{snapshot}")
        rows = self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        return rows.groupBy(*KEYS).agg(*[F.sum(s).cast("long").alias(s) for s in SUMS]).filter("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> None:
        """Fold all committed batches into a new snapshot. The list of its batches is written first and the snapshot counts only
        once complete, so an interruption leaves the old state. Batches are listed once, so one that is committed meanwhile is neither
        in the snapshot's sums nor in its list."""
        last, inside = self._snapshot()
        name = f"{int(last or 0) + 1:010d}"
        batches = self._folders("batches")
        totals = self._sums(last, inside, batches)
        self.spark.createDataFrame([(b,) for b in sorted({*batches, *inside})], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/lists/{name}")
        totals.write.mode("overwrite").parquet(f"{self.path}/snapshots/{name}")


def counted(docs: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens, clean_tokens, n_words, marked, row_id, row_hash): the counts of each text as it is and without
    markup symbols. Other columns are ignored."""
    texts = docs.select("doc_id", "source", "lang", *row_keys(), F.lit(version).alias("tokenizer"),
                        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n_words"),
                        F.coalesce(F.col("text").rlike(MARKUP), F.lit(False)).alias("marked"), "text",
                        F.when(F.col("text").rlike(MARKUP), F.regexp_replace("text", MARKUP + "+", "")).alias("clean"))
    out = token_lengths(texts, tokenizer, {"n_tokens": "text", "cleaned": "clean"})
    return out.withColumn("clean_tokens", F.when(F.col("marked"), F.col("cleaned")).otherwise(F.col("n_tokens"))).drop("cleaned")
