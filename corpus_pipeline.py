"""The corpus pipeline: quality rules, near-duplicates, benchmark passages, source weights, token files.

Each stage takes what its predecessor kept and returns documents again, the last the index of the token files it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarn.llm import decontaminate, mixing, quality, setsketch, token_files
from tarn.llm.common import documents, stored, table
from tarn.llm.tokens import word_bpe
from tarn.session import scratch_path, ship_package

#: the learned rules, sketches, seeded draws and the tokenizer have no SQL form; tests compare the stages with plain code
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list."""
    ship_package(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    ship_package(spark)
    return setsketch.keep_one(docs, words=5, threshold=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    ship_package(spark)
    return decontaminate.remove_passages(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as they are taken, the last one of a shard in part."""
    ship_package(spark)
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; returned is their index (doc_id, start, n_tokens, ids_crc32)."""
    ship_package(spark)
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(docs, path, word_bpe())
    return token_files.token_index(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage), ("near_duplicates", near_duplicate_stage), ("decontamination", decontamination_stage),
    ("mixing", mixing_stage), ("tokens", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's result is written and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
