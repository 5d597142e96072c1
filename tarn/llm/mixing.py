"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks, per source and per shard.

1. Targets share all words by weight; a source stops at ``REPEATS`` times its size and the others share the excess.
2. Blocks of ``BLOCK`` words go to sources by the highest quotients target / (2 k + 1), then within each source to its
   shards by size / (2 k + 1). Shards are seeded hash buckets, sqrt(documents) / ``SPREAD`` of them per source, so neither a
   shard nor the list of a source's shards grows faster than the root of the source.
3. Within a shard the documents form a ring in seeded order. The shard's quota is taken from the start of the ring, round
   and round, so every document is taken nearly equally often and only the last one is cut.

All of it is DataFrame code: one shuffle of (id, source, size) rows; everything else works on a row per source or shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import WORDS, passing_columns, stored, weights_by_position

WEIGHTS = (1.0, 2.0, 3.0)
REPEATS = 3
BLOCK = 64
SPREAD = 4
SEED = 11


def size_of(text: str = "text") -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``sizes`` (source, source_size, others) with ``target``, one row per source.

    Weights go round the sources in code point order, null last. With sources sorted by the share at which they
    reach their cap, the first ones are capped and the rest share what is left by weight; the number of
    capped ones is the smallest for which no later source is above its cap.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").cast("binary").asc_nulls_last())
    by_level = Window.partitionBy(F.lit(0)).orderBy("_level", F.col("source").cast("binary").asc_nulls_last())
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    later = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    w = sizes.withColumn("_weight", weights_by_position(F.row_number().over(by_name) - 1, weights))
    w = w.withColumn("_cap", (F.lit(repeats) * F.col("source_size")).cast("double")).withColumn("_level", F.col("_cap") / F.col("_weight"))
    w = w.withColumn("_share", (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0))) / F.sum("_weight").over(later))
    w = w.withColumn("_rate", F.min(F.when(F.col("_share") <= F.col("_level"), F.struct("_level", "_share"))).over(everything)["_share"])
    capped = F.col("_rate").isNull() | (F.col("_weight") * F.col("_rate") >= F.col("_cap"))
    return w.select(*sizes.columns, F.when(capped, F.col("_cap")).otherwise(F.col("_weight") * F.col("_rate")).alias("target"))


def apportion(parts: DataFrame, group: Sequence[str], seats: str, size: str, tie: Sequence[str | Column]) -> DataFrame:
    """``parts`` with ``quota``: Sainte-Lague shares of the group's ``seats`` in proportion to ``size``.

    The highest quotient of a part lies within half a seat of its scaled share for some common scale, which differs from 1
    by at most parts / (2 seats). So seats below that range are given at once and only quotients inside it are
    ranked: a few rows per part, however many seats there are.
    """
    whole = Window.partitionBy(*[F.col(g) for g in group]) if group else Window.partitionBy(F.lit(0))
    p = parts.withColumn("_parts", F.count(F.lit(1)).over(whole)).withColumn("_all", F.sum(size).over(whole))
    ideal = F.when(F.col("_all") > 0, F.col(seats) * F.col(size) / F.col("_all")).otherwise(F.lit(0.0))
    p = p.withColumn("_ideal", ideal)
    slack = F.col("_ideal") * F.col("_parts") / (2 * F.greatest(F.col(seats), F.lit(1))) + 2
    p = p.withColumn("_sure", F.greatest(F.lit(0), F.floor(F.col("_ideal") - slack)).cast("long")).withColumn("_most", F.ceil(F.col("_ideal") + slack).cast("long"))
    p = p.withColumn("_open", F.col(seats) - F.sum("_sure").over(whole))
    rest = p.select("*", F.explode(F.sequence("_sure", "_most")).alias("_seat")).withColumn("_quotient", F.col(size) / (2 * F.col("_seat") + 1))
    rank = F.row_number().over(whole.orderBy(F.desc("_quotient"), *tie, "_seat"))
    won = F.sum(F.when((F.col("_rank") <= F.col("_open")) & (F.col(size) > 0), 1).otherwise(0))
    return (rest.withColumn("_rank", rank).groupBy(*[F.col(f"`{c}`") for c in parts.columns], "_sure").agg(won.alias("_won"))
            .select(*parts.columns, (F.col("_sure") + F.col("_won")).alias("quota")))


def mixture(docs: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS, block: int = BLOCK,
            spread: float = SPREAD, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, size, source_size, target, taken), one row for each row of ``docs``.

    ``taken`` counts the words the mix takes from the document, repeats included, at most ``repeats`` times its size.
    Null texts have size 0 and are never taken; a null source is a source of its own, the last. The order within a
    shard is fixed by the seed, doc_id and text, so reruns agree; repeated rows share one draw and lie side by
    side. Without any words all targets are 0. Other columns are ignored.
    """
    rows = stored(docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), size_of().alias("size"))
                  .withColumn("draw", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text_hash"))), "sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    sources = stored(targets(per_source, weights, repeats), "sources")
    blocks = sources.withColumn("_blocks", F.round(F.sum("source_size").over(Window.partitionBy(F.lit(0))) / block).cast("long"))
    quotas = apportion(blocks, [], "_blocks", "target", [F.col("source").cast("binary").asc_nulls_last()])
    quotas = stored(quotas.select("source", "source_size", "target", F.col("quota").alias("_quota"),
                                  F.ceil(F.sqrt("_rows") / spread).cast("long").alias("_shards")), "quotas")

    def by_source(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("source", "_s")
        return left.join(F.broadcast(right) if small else right, left["source"].eqNullSafe(right["_s"])).drop("_s")

    small = quotas.limit(10_001).count() <= 10_000
    placed = by_source(rows, quotas.select("source", "_shards")).withColumn("_shard", F.pmod("draw", F.col("_shards"))).drop("_shards")
    shards = stored(placed.groupBy("source", "_shard").agg(F.sum("size").alias("_shard_size")), "shards")
    shard_quota = apportion(by_source(shards, quotas), ["source"], "_quota", "_shard_size", ["_shard"])
    shard_quota = stored(shard_quota.select("source", "_shard", "_shard_size", "source_size", "target",
                                            F.least(F.col("quota") * block, repeats * F.col("_shard_size")).alias("_take")), "shard-quotas")
    ring = Window.partitionBy("source", "_shard").orderBy("draw", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    ringed = placed.withColumn("_before", F.coalesce(F.sum("size").over(ring), F.lit(0)))
    q = shard_quota.withColumnRenamed("source", "_s").withColumnRenamed("_shard", "_t")
    out = ringed.join(q, ringed["source"].eqNullSafe(q["_s"]) & (ringed["_shard"] == q["_t"]))
    rounds = F.floor(F.col("_take") / F.greatest(F.col("_shard_size"), F.lit(1)))
    rest = F.col("_take") - rounds * F.col("_shard_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before")))
    return out.select("doc_id", "text_hash", "size", "source_size", "target", (rounds * F.col("size") + part).cast("long").alias("taken"))


@passing_columns("doc_id", "source", "text")
def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS, block: int = BLOCK,
          spread: float = SPREAD, seed: int = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document taken k times stands k times; of one taken in part, a further
    row holds that many of its first words, joined by spaces. Nothing is returned for documents not taken."""
    found = (mixture(docs.select("doc_id", "source", "text"), weights, repeats, block, spread, seed)
             .filter("taken > 0").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("size").alias("_size"), F.col("taken").alias("_taken"))
             .withColumn("_nth", F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("_taken"))))
    own = docs.withColumn("_text_hash", F.xxhash64("text"))
    own = own.withColumn("_number", F.row_number().over(Window.partitionBy("doc_id", "_text_hash").orderBy("source")))
    both = own.join(found, own["doc_id"].eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")) & (F.col("_number") == F.col("_nth")))
    whole = F.floor(F.col("_taken") / F.col("_size")).cast("int")
    rest = (F.col("_taken") % F.col("_size")).cast("int")
    copies = F.array_repeat(F.lit(0), whole)
    both = both.withColumn("_words", F.explode(F.when(rest > 0, F.array_append(copies, rest)).otherwise(copies)))
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all("text", F.lit(f"({WORDS})")), F.lit(1), F.col("_words")))
    return both.select(*[F.when(F.col("_words") > 0, cut).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c) for c in docs.columns])
