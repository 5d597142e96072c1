"""Ordered operators: per-key sequences, ranking, rolling statistics, top-k.

A key may own a large share of all rows, so sequences are cut into time chunks:
the window runs per (key, chunk), and a small per-chunk table carries the state
across the cuts. No task ever holds all events of one key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.session import cut_lineage

CHUNK_SECONDS = 3600
DAY_SECONDS = 86_400
FLAT = 1e-9  # a spread below this counts as none


def with_previous(df: DataFrame, columns: Sequence[str], key: str = "user_id", ts: str = "ts", tie: str = "login_id",
                  chunk_seconds: int = CHUNK_SECONDS, prefix: str = "prev_") -> DataFrame:
    """Values of the key's previous event (by time, then ``tie``) as ``prev_*`` columns.

    Same rows as ``lag`` over the whole key. Events are windowed per (key, second); the
    last event of each second, one small row, is carried to the key's next second,
    and the last one of each chunk to its next chunk. A busy hour of one key is
    therefore at most ``chunk_seconds`` rows in one task.
    """
    names = [prefix + c for c in columns]
    event = F.struct(*[F.col(c).alias(n) for c, n in zip(columns, names)])
    # a one-field struct lets NULL keys and times meet each other in a plain equality join
    timed = df.withColumns({"_key": F.struct(F.col(key).alias("k")), "_second": F.struct(F.unix_timestamp(ts).alias("s"))})
    inside = Window.partitionBy("_key", "_second").orderBy(ts, tie)
    seconds = timed.groupBy("_key", "_second").agg(F.max_by(event, F.struct(ts, tie)).alias("_last"))
    seconds = seconds.withColumn("_chunk", F.struct(F.floor(F.col("_second.s") / chunk_seconds).alias("c")))
    chunks = seconds.groupBy("_key", "_chunk").agg(F.max_by("_last", "_second").alias("_end"))
    ends = chunks.select("_key", "_chunk", F.lag("_end").over(Window.partitionBy("_key").orderBy("_chunk")).alias("_carried"))
    before_second = F.lag("_last").over(Window.partitionBy("_key", "_chunk").orderBy("_second"))
    carried = (seconds.withColumn("_before", before_second).join(ends, ["_key", "_chunk"], "left")
               .select("_key", "_second", F.coalesce("_before", "_carried").alias("_carried")))
    joined = timed.withColumn("_prev", F.lag(event).over(inside)).join(carried, ["_key", "_second"], "left")
    before = F.coalesce("_prev", "_carried")
    return joined.select(*df.columns, *[before.getField(n).alias(n) for n in names])


def with_gap(df: DataFrame, key: str = "user_id", ts: str = "ts", tie: str = "login_id") -> DataFrame:
    """Minutes since the key's previous event, NULL for the first."""
    out = with_previous(df, [ts], key, ts, tie)
    return out.withColumn("minutes_since_last", minutes_between(f"prev_{ts}", ts)).drop(f"prev_{ts}")


def minutes_between(earlier: str, later: str) -> Column:
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(60.0)


def count_recent(df: DataFrame, seconds: int = 3600, key: str = "user_id", ts: str = "ts",
                 name: str = "logins_last_hour") -> DataFrame:
    """Events of the key in the last ``seconds``, the current one included; NULL without a time.

    Events are counted per (key, second) first: the frame sees peers alike, so it
    holds at most 2 x ``seconds`` rows however many events there are. A second is
    also sent, as context only, to the next chunk, where it can still be inside a
    window; chunks are as long as the window, so one step is enough.
    """
    timed = df.withColumns({"_key": F.struct(F.col(key).alias("k")), "_epoch": F.unix_timestamp(ts)})
    per_second = timed.groupBy("_key", "_epoch").agg(F.count(F.lit(1)).alias("_n")).withColumn("_home", F.floor(F.col("_epoch") / seconds))
    spread = per_second.withColumn("_chunk", F.explode(F.array(F.col("_home"), F.col("_home") + 1)))
    w = Window.partitionBy("_key", "_chunk").orderBy("_epoch").rangeBetween(-seconds, 0)
    counted = spread.withColumn(name, F.sum("_n").over(w)).filter(F.col("_chunk") == F.col("_home")).select("_key", "_epoch", name)
    return timed.join(counted, ["_key", "_epoch"], "left").select(*df.columns, name)


def dedup(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in the given order; NULL keys form one group.

    Remaining columns break ties, so the result repeats. Spark cuts every group to
    its first row before the shuffle (window group limit), so copies do not pile up.
    """
    rest = [c for c in df.columns if c not in set(key) | set(order)]
    w = Window.partitionBy(*key).orderBy(*order, *rest)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_per_group(df: DataFrame, group: Sequence[str], by: Sequence[Column], k: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*by)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def latest_per_key(df: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    rest = [c for c in df.columns if c not in set(key) | {ts}]
    w = Window.partitionBy(*key).orderBy(F.desc(ts), *rest)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def series_key(partition: Sequence[str]) -> Column:
    """The columns of a series as one value, so that NULLs meet in joins; one constant without columns."""
    return F.struct(*[F.col(c) for c in partition]) if partition else F.struct(F.lit(0).alias("k"))


def with_row_index(df: DataFrame, order: str = "bucket_ts", partition: Sequence[str] = (), name: str = "_i",
                   chunk: int = DAY_SECONDS) -> DataFrame:
    """``df`` with the zero-based place of each row in its series.

    Rows are numbered inside chunks of ``chunk`` seconds (numbers: units of ``order``); a table of one row per chunk tells how many
    rows lie before it. No task sees a whole series. Rows without ``order`` come first, as one chunk. The rows are checkpointed,
    because they are read twice.
    """
    timed = dict(df.dtypes)[order] in ("timestamp", "timestamp_ntz", "date")
    unit = F.floor((F.unix_timestamp(F.col(order).cast("timestamp")) if timed else F.col(order)) / chunk)
    rows = cut_lineage(df.withColumns({"_series": series_key(partition), "_chunk": F.struct(unit.alias("c"))}))
    counts = rows.groupBy("_series", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_series").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_series", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_series", "_chunk").orderBy(order)) - 1
    return rows.withColumn("_at", inside).join(before, ["_series", "_chunk"]).select(
        *df.columns, (F.col("_before") + F.col("_at")).alias(name))


def rolling_z(df: DataFrame, columns: Mapping[str, str], order: str = "bucket_ts", rows: int = 864,
              min_rows: int = 288, partition: Sequence[str] = ()) -> DataFrame:
    """z of each column (name -> new name) against the last ``rows`` rows, itself included; 0 when undefined.

    A sliding frame would be re-summed for every row, so the series is cut into blocks of
    ``rows``: a window is the tail of one block plus the head of the next, and both have
    running moments that are merged. Blocks are windows of their own, and the tail that belongs
    to a row stands ``rows - 1`` places before it, that is, just before it among the places with the
    same remainder. So one series of any length is spread over many tasks. Sample standard
    deviation.
    """
    step = max(rows - 1, 1)
    same_place = Window.partitionBy(*partition, F.col("_i") % step).orderBy("_i")
    out = with_row_index(df, order, partition).withColumn("_block", F.floor(F.col("_i") / rows))
    head = Window.partitionBy(*partition, "_block").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    tail = Window.partitionBy(*partition, "_block").orderBy(F.desc("_i")).rowsBetween(Window.unboundedPreceding, 0)

    def moments(c: str, w) -> Column:
        n = F.count(c).over(w)
        return F.struct(n.alias("n"), F.coalesce(F.avg(c).over(w), F.lit(0.0)).alias("mean"),
                        F.coalesce(F.var_pop(c).over(w) * n, F.lit(0.0)).alias("m2"))

    out = out.withColumns({f"_h_{c}": moments(c, head) for c in columns})
    out = out.withColumns({f"_t_{c}": moments(c, tail) for c in columns})
    out = out.withColumns({f"_t_{c}": F.lag(f"_t_{c}", min(rows - 1, 1)).over(same_place) for c in columns})
    whole = (F.col("_i") < rows) | (F.col("_i") % rows == rows - 1)
    scores = {}
    for c, name in columns.items():
        h, t = F.col(f"_h_{c}"), F.col(f"_t_{c}")
        nt = F.when(whole, F.lit(0)).otherwise(t["n"])
        n = h["n"] + nt
        gap = F.when(nt > 0, t["mean"] - h["mean"]).otherwise(F.lit(0.0))
        mean = h["mean"] + gap * F.try_divide(nt, n)
        m2 = h["m2"] + F.when(nt > 0, t["m2"] + gap * gap * F.try_divide(h["n"] * nt, n)).otherwise(F.lit(0.0))
        std = F.sqrt(F.try_divide(m2, n - 1))
        scores[name] = F.coalesce(F.when((n >= min_rows) & (std > FLAT), (F.col(c) - mean) / std), F.lit(0.0))
    return out.withColumns(scores).drop("_i", "_block", *[f"_{k}_{c}" for k in "ht" for c in columns])


def top_k(df: DataFrame, by: str, k: int, tie: str, ascending: bool = False) -> DataFrame:
    """The k best rows; planned as a distributed top-k, not a full sort."""
    first = F.asc(by) if ascending else F.desc(by)
    return df.orderBy(first, F.asc(tie)).limit(k)


def around_peak(df: DataFrame, score: str = "anomaly_score", ts: str = "bucket_ts", hours: int = 12) -> DataFrame:
    """Rows within ``hours`` of the best-scoring row (earliest on ties)."""
    peak = df.agg(F.max_by(F.col(ts), F.struct(F.col(score), -F.unix_timestamp(ts))).alias("peak")).scalar()
    apart = F.abs(F.unix_timestamp(ts) - F.unix_timestamp(peak))
    return df.filter(apart <= hours * 3600)


def hash_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """n rows chosen by a seeded hash of the id: the same rows on every run, and in any engine that has MD5."""
    return df.orderBy(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")).cast("binary")), id_col).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
