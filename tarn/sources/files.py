"""File streams: JSON lines and append-only tables, picked up incrementally."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_raw_record"


def json_stream(spark: SparkSession, path: str, schema: str | T.StructType,
                max_files: int | None = None) -> DataFrame:
    """New JSON-lines files as an append stream with an explicit schema."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def stream_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """New rows of an append-only parquet table."""
    return spark.readStream.schema(schema).parquet(path)


def infer_json_schema(spark: SparkSession, path: str, schema_path: str, sampling_ratio: float = 1.0) -> T.StructType:
    """Infer the schema once and remember it as text next to the data.

    Later calls read the remembered schema, so a stream keeps its column types
    when new files arrive. Records that do not fit are kept whole in ``_raw_record``.
    """
    from tarn.sources.tables import inline, table_exists

    if not table_exists(spark, schema_path):
        found = spark.read.option("samplingRatio", sampling_ratio).json(path).schema
        found = T.StructType([*[f for f in found.fields if f.name != CORRUPT],
                              T.StructField(CORRUPT, T.StringType())])
        inline(spark, [(found.json(),)], "schema_json string").write.mode("overwrite").parquet(schema_path)
    import json

    return T.StructType.fromJson(json.loads(spark.read.parquet(schema_path).first()["schema_json"]))


def json_stream_inferred(spark: SparkSession, path: str, schema_path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """New JSON-lines files with the remembered schema; a record that doesn't parse or has other fields is also kept whole."""
    schema = infer_json_schema(spark, path, schema_path, sampling_ratio)
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    other = F.size(F.array_except(F.json_object_keys("value"), names)) > 0
    lines = spark.readStream.text(path).filter(F.trim("value") != "").withColumn("_parsed", parsed)
    kept = F.coalesce(F.col(f"_parsed.{CORRUPT}"), F.when(other, F.col("value")))
    return lines.select(*[kept.alias(CORRUPT) if f.name == CORRUPT else F.col(f"_parsed.`{f.name}`") for f in schema.fields])


def with_lineage(df: DataFrame) -> DataFrame:
    """Ingest time and source file of every row."""
    return df.select("*", F.current_timestamp().alias("_ingested_at"),
                     F.col("_metadata.file_path").alias("_source_file"))
