"""Exact ranks and quantiles without collecting a group.

Equal values are counted first. The distinct values are dealt to bins whose edges
are approximate quantiles of them, so far values do not crowd the rest into one
bin; a short table of bin totals gives the number of rows before each bin, and only
inside a bin are values ordered. A group of any size is therefore ranked by many
tasks, and the result is exact whatever the edges. A group with few distinct values is
one bin and has no edges, so that many small groups bring no table of edges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 512
WHOLE = 8           # a group of up to WHOLE x bins distinct values stays one bin
EDGE_ROWS = 4_096   # edges of more groups than this are not broadcast (16 MB at 512 bins)


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, value, n) of all non-missing values."""
    present = df.filter(F.col(value).isNotNull() & ~F.isnan(value)).select(*by, F.col(value).cast("double").alias("value"))
    return present.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))


def _binned(counts: DataFrame, by: Sequence[str], bins: int) -> DataFrame:
    from tarn.operators.joins import lookup

    by = list(by)
    bits = max(1, (bins - 1).bit_length())
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    edges = F.percentile_approx("value", shares, 10 * 2 ** bits).alias("_edges")
    if by:
        span = counts.groupBy(*by).agg(edges, F.count(F.lit(1)).alias("_values")).filter(F.col("_values") > WHOLE * bins).drop("_values")
        placed = lookup(counts, span, by, max_rows=EDGE_ROWS)
    else:
        placed = counts.withColumn("_edges", counts.select(edges).scalar())
    placed = placed.withColumn("_bin", F.lit(0))
    for bit in range(bits - 1, -1, -1):  # binary search: the number of edges up to the value
        ahead = F.col("_bin") + 2 ** bit
        placed = placed.withColumn("_bin", F.when(F.get("_edges", ahead - 1) <= F.col("value"), ahead).otherwise(F.col("_bin")))
    return placed.drop("_edges")


def ranked(counts: DataFrame, by: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """(by, value, n, total, below, upto): rows below the value and up to it, inside its group."""
    by = list(by)
    binned = _binned(counts, by, bins)
    totals = binned.groupBy(*by, "_bin").agg(F.sum("n").alias("_in_bin"))
    across = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = totals.select(*by, "_bin", (F.sum("_in_bin").over(across.orderBy("_bin")) - F.col("_in_bin")).alias("_before"),
                           F.sum("_in_bin").over(across).alias("total"))
    inside = Window.partitionBy(*by, "_bin").orderBy("value")
    return binned.join(before, [*by, "_bin"]).withColumn(
        "upto", F.col("_before") + F.sum("n").over(inside)).select(
        *by, "value", "n", "total", (F.col("upto") - F.col("n")).alias("below"), "upto")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float] | Column, by: Sequence[str] = (),
                    bins: int = BINS) -> DataFrame:
    """(by, prob, quantile) with linear interpolation between neighbouring rows.

    ``probs`` is a list, or a column over ``by`` and ``total`` for a share that
    depends on the group.
    """
    by = list(by)
    ranks = ranked(value_counts(df, value, by), by, bins)
    wanted = F.array(*[F.lit(float(p)) for p in probs]) if not isinstance(probs, Column) else F.array(probs)
    at = ranks.withColumn("prob", F.explode(wanted)).withColumn("_pos", F.col("prob") * (F.col("total") - 1))
    lo_here = (F.col("below") <= F.floor("_pos")) & (F.floor("_pos") < F.col("upto"))
    hi_here = (F.col("below") <= F.ceil("_pos")) & (F.ceil("_pos") < F.col("upto"))
    ends = at.filter(lo_here | hi_here).groupBy(*by, "prob").agg(
        F.min(F.when(lo_here, F.col("value"))).alias("_lo"), F.min(F.when(hi_here, F.col("value"))).alias("_hi"),
        F.first("_pos").alias("_pos"))
    between = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_pos") - F.floor("_pos"))
    return ends.select(*by, "prob", between.alias("quantile"))


def flag_quantile(df: DataFrame, value: str, prob: float, side: str = "above", name: str = "is_flagged") -> DataFrame:
    """1 for rows strictly above (or below) the given quantile of the column."""
    edge = exact_quantiles(df, value, [prob]).select("quantile").scalar()
    beyond = F.col(value) > edge if side == "above" else F.col(value) < edge
    return df.withColumn(name, F.when(beyond, 1).otherwise(0))


def flag_quantiles(df: DataFrame, names: Mapping[str, str], prob: float) -> DataFrame:
    """``flag_quantile`` (above) for several columns (column -> flag name) in one set of passes."""
    edges = exact_quantiles(unpivot(df, list(names)), "value", [prob], ["feature"]).agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "quantile"))).alias("m")).scalar()
    flags = {name: F.when(F.col(c) > F.col("_edges")[F.lit(c)], 1).otherwise(0) for c, name in names.items()}
    return df.withColumn("_edges", edges).withColumns(flags).drop("_edges")


def summary_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, all exact."""
    long = unpivot(df, columns)
    basic = long.groupBy("feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quarter = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["feature"]).groupBy("feature").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("p25"),
        F.max(F.when(F.col("prob") == 0.5, F.col("quantile"))).alias("p50"),
        F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("p75"))
    return basic.join(quarter, "feature", "left")


def unpivot(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Long form (ids, feature, value) of numeric columns."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(ids), list(columns), "feature", "value")
