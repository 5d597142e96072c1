"""Incremental scoring: only what is newer than the scored table, appended to it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.sources.tables import read_since, table_exists, write_table


def score_increment(source: DataFrame, path: str, score: Callable[[DataFrame], DataFrame], ts: str = "ts") -> bool:
    """Score the new rows and append them; False when there are none.

    ``score`` must give a row the same result alone or in a batch (fitted bounds),
    then any split into increments yields the same table.
    """
    spark = source.sparkSession
    if table_exists(spark, path):
        new = read_since(source, spark.read.parquet(path), ts)
    else:
        new = source.filter(F.col(ts) > F.lit("2000-01-01").cast("timestamp"))
    if new.isEmpty():
        return False
    write_table(score(new), path, "append")
    return True
