"""Batch tables: reading, literal rows, writing, watermarks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_path(directory: str, name: str, suffix: str = "") -> str:
    """Location of a table; ``suffix`` keeps the runs of several users apart."""
    tag = f"_{suffix}" if suffix else ""
    return f"{directory.rstrip('/')}/{name}{tag}.parquet"


def read_table(spark: SparkSession, directory: str, name: str, suffix: str = "") -> DataFrame:
    return spark.read.parquet(table_path(directory, name, suffix))


def inline(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """Literal rows with an explicit schema; no rows gives an empty typed frame."""
    return spark.createDataFrame(list(rows), schema=schema)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Iterable[str] = ()) -> None:
    writer = df.write.mode(mode)
    keys = list(partition_by)
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def ensure_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The table at ``path``, created empty with the given schema when missing."""
    if not table_exists(spark, path):
        write_table(inline(spark, [], schema), path, "errorifexists")
    return spark.read.parquet(path)


def materialize(build: Callable[..., DataFrame], inputs: Sequence[DataFrame], path: str) -> DataFrame:
    """Recompute a derived table and read it back, so later steps start from the stored rows."""
    out = build(*inputs)
    write_table(out, path)
    return out.sparkSession.read.parquet(path)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def land_jsonl(df: DataFrame, path: str, rows_per_file: int = 500) -> None:
    """Land rows as JSON-lines files holding at most ``rows_per_file`` rows each."""
    df.write.mode("append").option("maxRecordsPerFile", rows_per_file).json(path)


def to_json_rows(df: DataFrame) -> DataFrame:
    """Every row as one JSON document; stays distributed."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("payload"))


def read_since(source: DataFrame, scored: DataFrame, ts: str = "ts", default: str = "2000-01-01") -> DataFrame:
    """Rows newer than the newest scored row; everything after ``default`` when nothing is scored yet.

    The bound is a scalar subquery, so it is computed once and pushed to the scan.
    """
    newest = scored.agg(F.coalesce(F.max(ts), F.lit(default).cast("timestamp")).alias("newest")).scalar()
    return source.filter(F.col(ts) > newest)


def check_counts(frames: dict[str, DataFrame], expected: dict[str, int] | None = None) -> DataFrame:
    """Row count per named frame in one result; with ``expected`` a mismatch fails the run."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if expected is None:
        return out
    wanted = F.lit(None).cast("long")
    for n, want in expected.items():
        wanted = F.when(F.col("table_name") == n, F.lit(want).cast("long")).otherwise(wanted)
    message = F.concat(F.lit("row count of "), F.col("table_name"), F.lit(" is "), F.col("row_count").cast("string"))
    return out.withColumn("expected", wanted).withColumn(
        "row_count",
        F.when(F.col("expected").isNull() | (F.col("expected") == F.col("row_count")), F.col("row_count"))
        .otherwise(F.raise_error(message).cast("long")))
