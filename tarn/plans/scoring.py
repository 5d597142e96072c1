"""Composite scoring of new sign-ins with stored models.

A model is fitted once and written as a version of a store: the forest's nodes, the tail table, the sample and edge of every user, and
the bounds that bring the three layers and their sum to [0, 1]. New rows are scored against these tables alone, so a
row gets the same score by itself, in any batch, and in one run over everything.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.operators import forest as fo
from tarn.operators.ensemble import composite_risk, fit_composite
from tarn.operators.tails import fit_tails, tail_scores
from tarn.plans.signins import MODEL_FEATURES
from tarn.session import cut_lineage
from tarn.sources.tables import table_exists, write_table

VERSIONS = "version long, folder string, parts array<string>, fitted_rows long, fitted_through timestamp"


class ModelStore:
    """Versions of a model, each a set of Parquet tables. A version exists once its row is in the list, which is written last."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> DataFrame:
        if table_exists(self.spark, f"{self.path}/versions"):
            return self.spark.read.schema(VERSIONS).parquet(f"{self.path}/versions")
        return self.spark.createDataFrame([], VERSIONS)

    def save(self, parts: Mapping[str, DataFrame], fitted_on: DataFrame | None = None, ts: str = "ts") -> int:
        """Write all parts to a folder of their own, then list them as the next version."""
        folder = f"{self.path}/{uuid.uuid4().hex}"
        for name, part in parts.items():
            write_table(part, f"{folder}/{name}", "errorifexists")
        facts = (0, None) if fitted_on is None else tuple(fitted_on.agg(F.count(F.lit(1)), F.max(ts)).first())
        version = (self.versions().agg(F.max("version")).first()[0] or 0) + 1
        write_table(self.spark.createDataFrame([(version, folder, sorted(parts), *facts)], VERSIONS).coalesce(1), f"{self.path}/versions", "append")
        return version

    def load(self, version: int | None = None) -> dict[str, DataFrame]:
        """Tables of a version, by default of the newest one."""
        listed = self.versions() if version is None else self.versions().filter(F.col("version") == version)
        row = listed.orderBy(F.desc("version")).first()
        if row is None:
            raise LookupError(f"no version {version or ''} in {self.path}")
        return {name: self.spark.read.parquet(f"{row['folder']}/{name}") for name in row["parts"]}


def _layers(forest: DataFrame, tails: DataFrame, users: DataFrame) -> DataFrame:
    return forest.join(tails.select("login_id", "ecod"), "login_id").join(
        users.select("login_id", F.col("per_user_score").alias("per_user")), "login_id")


def fit(rows: DataFrame, columns: Sequence[str] = MODEL_FEATURES, n_trees: int = 200, user_trees: int = 100) -> dict[str, DataFrame]:
    """All parts of a composite model from training rows (login_id, user_id, feature columns)."""
    forest = fo.iforest_fit(rows, columns, n_trees=n_trees)
    tails = cut_lineage(fit_tails(rows, columns))
    samples, edges, raw = fo.per_user_fit_scores(rows, columns, n_trees=user_trees)
    parts = {"forest": forest, "tails": tails, "samples": samples, "edges": cut_lineage(edges)}
    return parts | {"bounds": fit_composite(cut_lineage(layers(rows, parts, columns, user_trees, raw)))}


def layers(rows: DataFrame, model: Mapping[str, DataFrame], columns: Sequence[str] = MODEL_FEATURES, user_trees: int = 100,
           raw: DataFrame | None = None) -> DataFrame:
    """(login_id, iforest, ecod, per_user) of rows by the stored tables; ``raw``: the raw scores of the user models, where they are known."""
    return _layers(fo.iforest_score(rows, model["forest"], columns), tail_scores(rows, columns, model=model["tails"]),
                   fo.per_user_apply(rows, model["samples"], model["edges"], columns, n_trees=user_trees, raw=raw))


def score(rows: DataFrame, model: Mapping[str, DataFrame], columns: Sequence[str] = MODEL_FEATURES, user_trees: int = 100,
          keep: Sequence[str] = ("login_id", "user_id", "ts")) -> DataFrame:
    """Signals, risk, tier and flag of every row; for flagged rows the two features that made them unusual."""
    risk = cut_lineage(composite_risk(layers(rows, model, columns, user_trees), model["bounds"]))
    flagged = rows.join(risk.filter("is_anomaly = 1").select("login_id"), "login_id", "left_semi")
    tops = fo.explain(flagged, model["forest"], columns, 2).drop("attribution_sum", "base")
    return rows.select(*keep).join(risk, "login_id").join(tops, "login_id", "left")


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> None:
    """Score everything new in ``stream`` and stop. Each micro-batch owns the folder of its id, so a batch that is run again after a
    failure replaces its own rows and adds none."""
    def step(batch: DataFrame, batch_id: int) -> None:
        write_table(scorer(batch), f"{path}/batch_id={batch_id}")

    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
