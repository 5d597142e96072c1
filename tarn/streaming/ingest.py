"""Streams that run to completion over new files and resume from their checkpoint."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from tarn.operators.quality import Rule, expect, observed, write_counts
from tarn.plans.medallion import ORDER_RULES, typed_orders
from tarn.sources.files import json_stream, stream_table, with_lineage


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for a stream that starts inside: a started stream keeps those it was started with."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_to(df: DataFrame, path: str, checkpoint: str, once: bool = True, **conf: str):
    """Exactly-once append to a parquet table; with ``once`` it processes what is there and stops. ``conf`` holds for this stream only."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    with settings(df.sparkSession, conf):
        started = (writer.trigger(availableNow=True) if once else writer).start()
    if once:
        started.awaitTermination()
    return started


def ingest_stream(spark: SparkSession, source: str, schema: str | T.StructType, path: str, checkpoint: str,
                  max_files: int | None = None):
    """JSON-lines files to a bronze table with ingest time and source file."""
    return stream_to(with_lineage(json_stream(spark, source, schema, max_files)), path, checkpoint)


class ViolationLog(StreamingQueryListener):
    """Keeps the observed violation counts of each micro-batch as a table (rule, action, violations, batch_id).

    Every batch owns the folder of its id, so a batch that runs again after a failure replaces its counts. Batches without rows leave none.
    """

    def __init__(self, spark: SparkSession, name: str, rules: Sequence[Rule], path: str):
        self.spark, self.name, self.rules, self.path = spark, name, list(rules), path
        self.failure: Exception | None = None
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        counts = event.progress.observedMetrics.get(self.name)
        if counts is None or not event.progress.numInputRows:
            return
        try:
            write_counts(self.spark, self.rules, counts.asDict(), f"{self.path}/batch_id={event.progress.batchId}")
        except Exception as err:  # listeners run beside the stream: hand the failure to the one who waits for it
            self.failure = err

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.set()


@contextmanager
def violation_log(spark: SparkSession, name: str, rules: Sequence[Rule], path: str, wait: float = 60.0) -> Iterator[ViolationLog]:
    """Listen to the streams that run inside; on leaving, wait until the counts of the ended stream are written."""
    log = ViolationLog(spark, name, rules, path)
    spark.streams.addListener(log)
    try:
        yield log
        if not log.ended.wait(wait):
            raise TimeoutError(f"no end of the stream was reported within {wait} seconds")
    finally:
        spark.streams.removeListener(log)
    if log.failure is not None:
        raise log.failure


def silver_orders_stream(spark: SparkSession, source: str, schema: str | T.StructType, path: str, checkpoint: str, violations: str | None = None):
    """Raw order rows of an append-only table to typed, checked orders.

    With ``violations`` the counts of each micro-batch are kept there as a table, dropped rows included.
    """
    raw = stream_table(spark, source, schema)
    counted = expect(observed(typed_orders(raw), ORDER_RULES, "order_rules"), ORDER_RULES)
    if violations is None:
        return stream_to(counted, path, checkpoint)
    with violation_log(spark, "order_rules", ORDER_RULES, violations):
        return stream_to(counted, path, checkpoint)
