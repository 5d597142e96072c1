"""Named queries and, where SQL can express them, the equivalent ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return present(fn(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Engine-neutral output: rounded doubles, long integers, text for dates and lists."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws("|", c.cast("array<string>"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def r6(expr: str, name: str | None = None) -> str:
    """SQL counterpart of ``present`` for one double column."""
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0 AS {name or expr}"


def big(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def mean3(expr: str, name: str) -> str:
    """SQL counterpart of ``mean_score``: half-up rounding of an exact mean, in integers."""
    total = f"sum(CAST(round({expr} * 1000000000) AS HUGEINT))"
    return f"((2 * {total} + 1000000 * count(*)) // (2000000 * count(*))) / CAST(1000 AS DOUBLE) AS {name}"
