"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.session import scratch_path, small_batches

WORDS = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the folder that all executors share and go on from there: read many times, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_keys(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two longs without nulls that identify a row; repeated rows share them. An id that is no whole number stands by its hash."""
    given = F.col(doc_id)
    number = F.when(F.typeof(given).isin("tinyint", "smallint", "int", "bigint"), given.try_cast("long"))
    return [F.when(given.isNull(), F.lit(0)).otherwise(F.coalesce(number, F.xxhash64(given))).alias("row_id"),
            F.xxhash64(F.col(text), F.col(doc_id).isNull()).alias("row_hash")]


def passing_columns(*used: str) -> Callable:
    """For operators that return the columns of ``docs``: inside, all columns but ``used`` have names that clash with nothing."""
    def wrap(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(fn)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            inside = docs.toDF(*[c if c.lower() in used else f"passed{i}" for i, c in enumerate(docs.columns)])
            return fn(inside, *args, **kwargs).toDF(*docs.columns)
        return run
    return wrap


#: what operators keep in a worker process between tasks, as functions that let go of it
HELD: list[Callable[[], None]] = []


def let_go() -> None:
    """Workers outlive stages: an operator that starts frees what another one kept there."""
    for drop in HELD:
        drop()
    pa.default_memory_pool().release_unused()


def slices(batch: pa.RecordBatch, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes, so that Python objects made from it stay few at a time."""
    step = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for first in range(0, batch.num_rows, step):
        yield batch.slice(first, step)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch | pa.Table]], schema: str,
                hold: bool = False) -> DataFrame:
    """Apply ``fn`` to each Arrow batch, a piece at a time; it may give any number of batches or tables. With ``hold`` the worker
    keeps what earlier tasks have left for it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not hold:
            let_go()
        for batch in batches:
            for piece in slices(batch):
                for out in fn(piece):
                    yield from (out.to_batches() if isinstance(out, pa.Table) else [out])
        pa.default_memory_pool().release_unused()  # workers live on between tasks

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def weights_by_position(order: Column, weights: Sequence[float]) -> Column:
    """Cycle through ``weights`` by a zero-based position."""
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(order, F.lit(len(weights))) + 1).cast("int"))
