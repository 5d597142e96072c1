"""Tail scores from empirical distributions (ECOD, COPOD), for any number of rows.

Per feature L = -ln share(<= x) and R = -ln share(>= x); the sign of the skewness
picks the tail that counts. Both detectors read the same table of distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.operators.quantiles import ranked, unpivot, value_counts
from tarn.session import cut_lineage

HOT_SHARE = 1000


def join_by_value(facts: DataFrame, reference: DataFrame, on: Sequence[str], n: str = "n", total: str = "total",
                  spread: int = 1024) -> DataFrame:
    """Left join with a table that knows how often each key occurs.

    At most ``HOT_SHARE`` keys per group can hold 1/HOT_SHARE of its rows; those few
    are broadcast. Facts served by them are spread at random over the second,
    shuffled join, so no hot key meets in one task.
    """
    on = list(on)
    payload = [c for c in reference.columns if c not in on]
    hot_rows = F.col(n) * HOT_SHARE >= F.col(total)
    hot = reference.filter(hot_rows).select(*on, F.struct(*payload).alias("_hot"))
    cold = reference.filter(~hot_rows).select(*on, F.lit(-1).alias("_spread"), F.struct(*payload).alias("_cold"))
    first = facts.join(F.broadcast(hot), on, "left")
    lane = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(spread)).cast("int")
    first = first.withColumn("_spread", F.when(F.col("_hot").isNotNull(), lane).otherwise(-1))
    joined = first.join(cold, [*on, "_spread"], "left").withColumn("_found", F.coalesce("_hot", "_cold"))
    return joined.select(*facts.columns, *[F.col(f"_found.{c}").alias(c) for c in payload])


def skew_signs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, sign) with sign -1, 0 or 1; a constant feature has 0."""
    wide = df.agg(*[F.signum(F.coalesce(F.nanvl(F.skewness(c), F.lit(0.0)), F.lit(0.0))).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "feature", "sign")


def _contributions(ranks: DataFrame) -> DataFrame:
    """Adds what a value contributes to both detectors; a value beyond the fitted rows counts as their outermost one."""
    left = -F.log(F.greatest(F.col("upto"), F.lit(1)) / F.col("total"))
    right = -F.log(F.greatest(F.col("total") - F.col("below"), F.lit(1)) / F.col("total"))
    skewed = F.when(F.col("sign") < 0, F.col("_l")).when(F.col("sign") > 0, F.col("_r")).otherwise(F.col("_l") + F.col("_r"))
    return ranks.withColumns({"_l": left, "_r": right}).select(
        "feature", "value", "n", "total", "sign", F.greatest("_l", "_r", skewed).alias("ecod"),
        F.greatest(skewed, (F.col("_l") + F.col("_r")) / 2).alias("copod"))


def fit_tails(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n, total, sign, ecod, copod): the contribution of every distinct value."""
    long = unpivot(df, columns)
    ranks = ranked(value_counts(long, "value", ["feature"]), ["feature"])
    return _contributions(ranks.join(F.broadcast(skew_signs(df, columns)), "feature"))


def with_new_values(model: DataFrame, long: DataFrame) -> DataFrame:
    """The fitted table with rows for those values of ``long`` (feature, value) that it does not hold.

    New values take their place among the fitted ones and carry no weight, so what they get does not depend on what else is scored with them.
    """
    new = value_counts(long, "value", ["feature"]).join(model, ["feature", "value"], "left_anti").withColumnRenamed("n", "_new")
    every = model.select("feature", "value", "n").unionByName(new.select("feature", "value", F.lit(0).cast("long").alias("n")))
    placed = ranked(every, ["feature"]).filter("n = 0")
    signs = model.groupBy("feature").agg(F.max("sign").alias("sign"))
    rows = placed.drop("n").join(new, ["feature", "value"]).withColumnRenamed("_new", "n").join(F.broadcast(signs), "feature")
    return model.unionByName(_contributions(rows))


def tail_scores(df: DataFrame, columns: Sequence[str], id_col: str = "login_id", model: DataFrame | None = None) -> DataFrame:
    """(id, ecod, copod): contributions summed over the features; higher is more unusual.

    Without a stored ``model`` the rows are scored against themselves.
    """
    long = unpivot(df, columns, [id_col])
    model = cut_lineage(fit_tails(df, columns) if model is None else with_new_values(model, long))
    joined = join_by_value(long, model, ["feature", "value"])
    return joined.groupBy(id_col).agg(F.sum("ecod").alias("ecod"), F.sum("copod").alias("copod"))


def ecod_score(df: DataFrame, columns: Sequence[str], id_col: str = "login_id") -> DataFrame:
    return tail_scores(df, columns, id_col).select(id_col, "ecod")


def copod_score(df: DataFrame, columns: Sequence[str], id_col: str = "login_id") -> DataFrame:
    return tail_scores(df, columns, id_col).select(id_col, "copod")
