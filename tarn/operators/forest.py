"""Isolation forests on Spark: one global model, one model per user, explanations."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.operators.joins import lookup
from tarn.operators.quantiles import exact_quantiles
from tarn.operators.trees import Forest, anomaly_score, attributions, forest_attributions, grow, leaf_paths
from tarn.session import cut_lineage, spread

NODE_SCHEMA = ("tree_id int, node_id int, parent int, feature int, threshold double, left_id int, right_id int, "
               "size long, depth int, psi int")
CHUNK_ROWS = 200_000
MIN_USER_ROWS = 20
SAMPLE, ROW, BOTH = 0, 1, 2  # what a row of the stream to the forests is for


def unit_hash(*cols: Column) -> Column:
    """A repeatable number in [0, 1) per row."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def iforest_fit(df: DataFrame, columns: Sequence[str], id_col: str = "login_id", n_trees: int = 200, n_sub: int = 256,
                seed: int = 42) -> DataFrame:
    """Node table of the forest.

    Each row draws how many trees it goes to and, by seeded hashes, one tree from
    each of as many equal ranges of trees; only these (row, tree) pairs are made.
    A tree keeps the first ``n_sub`` of its rows. The scheme is the same for any
    number of rows, and a shuffle of about 1.6 x n_trees x n_sub rows is enough.
    """
    columns = list(columns)
    n = df.count()
    psi = min(n_sub, n)
    rows = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in columns])
    key, s = F.col(id_col), F.lit(seed)
    expected = min(1.0, (1.5 * psi + 30) / max(n, 1)) * n_trees  # trees per row
    count = F.floor(F.lit(expected) + unit_hash(key, s, F.lit("count"))).cast("int")
    drawn = rows.withColumn("_m", F.least(F.lit(n_trees), count)).filter("_m > 0")
    ranges = F.transform(F.sequence(F.lit(0), F.col("_m") - 1), lambda j: F.floor(
        (j + unit_hash(key, s, j)) * n_trees / F.col("_m")).cast("int"))
    drawn = drawn.withColumn("tree_id", F.explode(F.array_distinct(ranges))).drop("_m")
    w = Window.partitionBy("tree_id").orderBy(F.xxhash64(key, s, F.col("tree_id")), id_col)
    drawn = drawn.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= psi)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree_id"].iloc[0])
        x = pdf.sort_values("_rn")[columns].to_numpy(dtype=float)
        f = grow(x, [np.arange(len(x))], psi, np.random.default_rng([seed, t]))
        k = len(f.tree)
        return pd.DataFrame({"tree_id": t, "node_id": np.arange(k), "parent": f.parent, "feature": f.feature,
                             "threshold": f.threshold, "left_id": f.left, "right_id": f.right, "size": f.size,
                             "depth": f.depth, "psi": psi})

    return cut_lineage(spread(drawn, "tree_id").groupBy("tree_id").applyInPandas(build, NODE_SCHEMA))


def load_forest(nodes: DataFrame) -> Forest:
    """The node table as arrays; at most n_trees x (2 x n_sub - 1) model rows reach the driver."""
    pdf = nodes.toPandas().sort_values(["tree_id", "node_id"])
    offset = pdf.groupby("tree_id").size().cumsum().shift(fill_value=0)
    shift = pdf["tree_id"].map(offset).to_numpy()

    def moved(c):
        v = pdf[c].to_numpy()
        return np.where(v >= 0, v + shift, -1)

    return Forest(pdf["tree_id"].to_numpy(), moved("parent"), pdf["feature"].to_numpy(), pdf["threshold"].to_numpy(),
                  moved("left_id"), moved("right_id"), pdf["size"].to_numpy(), pdf["depth"].to_numpy(),
                  int(pdf["psi"].iloc[0]))


def iforest_score(df: DataFrame, nodes: DataFrame, columns: Sequence[str], id_col: str = "login_id") -> DataFrame:
    """(id, iforest): raw score of every row, lower is worse."""
    columns = list(columns)
    model = df.sparkSession.sparkContext.broadcast(load_forest(nodes))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({id_col: pdf[id_col], "iforest": anomaly_score(model.value, pdf[columns].to_numpy(dtype=float))})

    id_type = dict(df.dtypes)[id_col]
    return df.select(id_col, *[F.col(c).cast("double").alias(c) for c in columns]).mapInPandas(
        score, f"{id_col} {id_type}, iforest double")


def iforest_decision(scored: DataFrame, contamination: float = 0.05) -> DataFrame:
    """Shift the raw score by its contamination quantile; negative means flagged."""
    edge = exact_quantiles(scored, "iforest", [contamination]).select("quantile").scalar()
    out = scored.withColumn("decision", F.col("iforest") - edge)
    return out.withColumn("is_anomaly", F.when(F.col("decision") < 0, 1).otherwise(0))


def _top_features(phi: np.ndarray, columns: Sequence[str], k: int) -> dict[str, object]:
    order = np.argsort(-np.abs(phi), axis=1, kind="stable")[:, :k]
    out: dict[str, object] = {}
    names = np.array(columns, dtype=object)
    for j in range(min(k, phi.shape[1])):
        out[f"top{j + 1}_feature"] = names[order[:, j]]
        out[f"top{j + 1}_value"] = phi[np.arange(len(phi)), order[:, j]]
    return out


def _top_names(k: int) -> list[str]:
    return [f"top{j}_{what}" for j in range(1, k + 1) for what in ("feature", "value")]


def _top_schema(k: int) -> str:
    return ", ".join(f"top{j}_feature string, top{j}_value double" for j in range(1, k + 1))


def explain(df: DataFrame, nodes: DataFrame, columns: Sequence[str], k: int = 2, id_col: str = "login_id") -> DataFrame:
    """The k features that move a row's path length most, with the sum of all attributions and the base.

    Meant for flagged rows. Negative values shorten the path: more unusual. The rows are few bytes for much work, so they are
    dealt over a fixed count of partitions.
    """
    columns = list(columns)
    model = df.sparkSession.sparkContext.broadcast(leaf_paths(load_forest(nodes)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            phi = attributions(model.value, pdf[columns].to_numpy(dtype=float), len(columns))
            yield pd.DataFrame({id_col: pdf[id_col], "attribution_sum": phi.sum(axis=1), "base": model.value.base,
                                **_top_features(phi, columns, k)})

    id_type = dict(df.dtypes)[id_col]
    rows = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in columns])
    return spread(rows, *rows.columns).mapInPandas(run, f"{id_col} {id_type}, attribution_sum double, base double, {_top_schema(k)}")


def user_forest(name: str, sample: np.ndarray, n_trees: int, n_sub: int, seed: int) -> Forest:
    """The forest of a user: it depends on the sample in its order, the seed and the user's name."""
    rng = np.random.default_rng([seed, zlib.crc32(name.encode())])
    psi = min(n_sub, len(sample))
    return grow(sample, [rng.permutation(len(sample))[:psi] for _ in range(n_trees)], psi, rng)


class _PerUser:
    """Rows of every user cut into chunks, each chunk next to the user's training sample.

    A user may own any share of the rows: chunks hold about ``CHUNK_ROWS`` rows and
    the sample at most n_trees x n_sub, so no task sees a whole large user. Every
    chunk grows the same forest from the same sample and seed. Tree splits do not
    depend on the scale of a feature, so the rows need no scaling per user.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], id_col: str, user: str, n_trees: int, n_sub: int, seed: int):
        self.columns, self.id_col, self.user = list(columns), id_col, user
        self.n_trees, self.n_sub, self.seed = n_trees, n_sub, seed
        self.limit = n_trees * n_sub
        self.whole = min(self.limit, CHUNK_ROWS)  # a user up to this is one chunk and its own sample
        rows = df.select(id_col, user, *[F.col(c).cast("double").alias(c) for c in self.columns])
        counts = cut_lineage(rows.groupBy(user).agg(F.count(F.lit(1)).alias("_n")))
        self.most = counts.filter(F.col(user).isNotNull()).agg(F.max("_n")).first()[0] or 0
        self.rows = lookup(rows, counts, [user]).withColumn("_chunks", F.ceil(F.col("_n") / CHUNK_ROWS).cast("int"))

    def chunked(self, rows: DataFrame) -> DataFrame:
        lane = F.pmod(F.xxhash64(F.col(self.id_col), F.lit("chunk")), F.col("_chunks")).cast("int")
        return rows.withColumn("_chunk", lane)

    def _draw(self) -> Column:
        return unit_hash(F.col(self.id_col), F.lit(self.seed))

    def samples(self, above: int = 0) -> DataFrame:
        """(_user, _rn, columns): the rows the forest of each user with more than ``above`` rows is grown from, at most n_trees x n_sub."""
        limit, draw = self.limit, self._draw()
        thin = self.rows.filter((F.col("_n") > above) & (F.col("_n") >= MIN_USER_ROWS) & ((F.col("_n") <= limit) | (draw < 1.2 * limit / F.col("_n"))))
        # the first rows by draw: the filter above only spares the window rows that can't be among them
        w = Window.partitionBy(self.user).orderBy(draw, self.id_col)
        thin = thin.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit)
        return thin.select(F.col(self.user).alias("_user"), "_rn", *[F.col(c).alias(c) for c in self.columns])

    def _stream(self, rows: DataFrame | None, samples: DataFrame | None) -> DataFrame:
        """Sample rows, in order, and rows to work on, user by user and chunk by chunk; one row may be both."""
        id_type = dict(self.rows.dtypes)[self.id_col]
        draw, small = self._draw(), F.col("_n") <= self.whole
        enough = self.rows.filter(F.col("_n") >= MIN_USER_ROWS)

        def part(df: DataFrame, kind: int, order: Column, key: Column | None = None) -> DataFrame:
            return df.select(F.col(self.user).alias("_user"), "_chunk", F.lit(kind).alias("_kind"), order.cast("double").alias("_order"),
                             (F.col(self.id_col) if key is None else key).alias("_id"), *self.columns)

        out, work = [], rows
        if samples is None:
            if rows is None:
                out.append(part(self.chunked(enough.filter(small)), BOTH, draw))
                work = enough.filter(~small) if self.most > self.whole else None
            else:
                out.append(part(enough.filter(small).withColumn("_chunk", F.lit(0)), SAMPLE, draw))
            samples = self.samples(self.whole) if self.most > self.whole else None
        if work is not None:
            work = self.chunked(work)
            out.append(part(work, ROW, F.lit(0.0)))
        if samples is not None:
            near = samples.withColumn("_chunk", F.lit(0))
            if self.most > CHUNK_ROWS:  # at most one chunk for every CHUNK_ROWS rows
                more = work.filter("_chunk > 0").select(F.col(self.user).alias("_user"), "_chunk").distinct()
                near = near.unionByName(samples.join(F.broadcast(more), "_user"))
            out.append(part(near.withColumn(self.user, F.col("_user")), SAMPLE, F.col("_rn"), F.lit(None).cast(id_type)))
        every = reduce(lambda a, b: a.unionByName(b), out).filter(F.col("_user").isNotNull())
        return spread(every, "_user", "_chunk").sortWithinPartitions("_user", "_chunk", "_kind", "_order", "_id")

    def run(self, work, schema: str, rows: DataFrame | None = None, samples: DataFrame | None = None) -> DataFrame:
        """``work(forest, x) -> dict of columns`` for ``rows`` (default: all rows of users with enough of them), by the forest of each
        user, grown from ``samples`` (default: of these users' rows). Users without a sample are left out."""
        id_col, columns, n_trees, n_sub, seed = self.id_col, self.columns, self.n_trees, self.n_sub, self.seed
        stream = self._stream(rows, samples)
        id_type = dict(stream.dtypes)["_id"]

        def one(name: str, kind: np.ndarray, x: np.ndarray) -> dict[str, np.ndarray] | None:
            sample = x[kind != ROW]
            if not len(sample) or not (kind != SAMPLE).any():
                return None
            return work(user_forest(name, sample, n_trees, n_sub, seed), x[kind != SAMPLE])

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table, starts in _whole_groups(batches, ["_user", "_chunk"]):
                users, kind = table.column("_user").take(pa.array(starts[:-1])).to_pandas(), table.column("_kind").to_numpy()
                x = np.column_stack([table.column(c).to_numpy() for c in columns])
                found, at = [], []
                for name, i, j in zip(users, starts[:-1], starts[1:]):
                    got = one(str(name), kind[i:j], x[i:j])
                    if got is not None:
                        found.append(got)
                        at.append(i + np.flatnonzero(kind[i:j] != SAMPLE))
                if found:
                    ids = table.column("_id").take(pa.array(np.concatenate(at))).combine_chunks()
                    yield pa.RecordBatch.from_arrays([ids, *[pa.array(np.concatenate([f[c] for f in found])) for c in found[0]]], names=[id_col, *found[0]])

        return stream.mapInArrow(task, f"{id_col} {id_type}, {schema}")


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole runs of rows with equal keys, and where each begins (and the last ends); a run may go over many batches."""
    def begins(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for k in keys:
            ends = pc.run_end_encode(table.column(k).combine_chunks()).run_ends.to_numpy()
            new[ends[:-1]] = True
        return np.flatnonzero(new)

    held: list[pa.RecordBatch | pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        seam = pa.Table.from_batches([*[h.slice(0, 1) for h in held[:1]], batch])
        if held and len(begins(seam)) == 1:  # all of it belongs to the run that is held
            held.append(batch)
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        starts = begins(table)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts
        held = table.slice(starts[-1]).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, np.array([0, table.num_rows])


def _contamination(total):
    """Share of a user's rows that is flagged, as a column or a number."""
    if isinstance(total, Column):
        return F.least(F.lit(0.1), F.greatest(F.lit(0.01), F.lit(5.0) / total))
    return min(0.1, max(0.01, 5.0 / total))


def _edge(raw: np.ndarray) -> float:
    """The contamination quantile of one user's raw scores, as ``exact_quantiles`` has it."""
    at = _contamination(len(raw)) * (len(raw) - 1)
    low, high = math.floor(at), math.ceil(at)
    ends = np.partition(raw, (low, high))[[low, high]]
    return ends[0] + (ends[1] - ends[0]) * (at - low)


def _by_user(rows: DataFrame, id_col: str, user: str, whole: int) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows of users that one task can score by itself, and all others (or None).

    The others have more than ``whole`` rows, no user id, or a row whose id is null or occurs again: rows are put together by id
    there, whoever owns them.
    """
    again = rows.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | F.col(id_col).isNull())
    again = cut_lineage(again.select(id_col))
    others = rows.groupBy(user).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > whole) | F.col(user).isNull()).select(user)
    if not again.isEmpty():
        others = others.union(rows.filter(F.col(id_col).isNull()).select(user)).union(rows.join(again, id_col, "left_semi").select(user)).distinct()
    others = cut_lineage(others.withColumn("_other", F.lit(1)))
    if others.isEmpty():
        return rows, None
    marked = lookup(rows, others.filter(F.col(user).isNotNull()), [user])
    apart = F.col(user).isNull() | F.coalesce(F.col("_other") == 1, F.lit(False))
    return marked.filter(~apart).drop("_other"), marked.filter(apart).drop("_other")


def _score_whole_users(rows: DataFrame, columns: Sequence[str], id_col: str, user: str, n_trees: int, n_sub: int, seed: int,
                       k: int = 0, flagged_only: bool = True) -> DataFrame:
    """Scores of users whose rows fit one task, and with ``k`` the strongest features of (flagged) rows: a forest is grown once for both."""
    draw = unit_hash(F.col(id_col), F.lit(seed))
    stream = rows.select(F.col(user).alias("_user"), F.col(id_col).alias("_id"), draw.alias("_order"), *columns)
    stream = spread(stream, "_user").sortWithinPartitions("_user", "_order", "_id")
    columns, tops = list(columns), _top_names(k)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_groups(batches, ["_user"]):
            names = table.column("_user").take(pa.array(starts[:-1])).to_pandas()
            x = np.column_stack([table.column(c).to_numpy() for c in columns])
            score, features, values = np.zeros(len(x)), np.full((len(x), k), None, object), np.full((len(x), k), np.nan)
            for name, i, j in zip(names, starts[:-1], starts[1:]):
                if j - i < MIN_USER_ROWS:
                    continue
                forest = user_forest(str(name), x[i:j], n_trees, n_sub, seed)
                raw = anomaly_score(forest, x[i:j])
                score[i:j] = raw - _edge(raw)
                wanted = i + np.flatnonzero(score[i:j] < 0) if flagged_only else np.arange(i, j)
                if k and len(wanted):
                    best = _top_features(forest_attributions(forest, x[wanted], len(columns)), columns, k)
                    for c in range(min(k, len(columns))):
                        features[wanted, c], values[wanted, c] = best[f"top{c + 1}_feature"], best[f"top{c + 1}_value"]
            n = np.diff(starts)
            told = [pa.array(a) for c in range(min(k, len(columns))) for a in (pa.array(features[:, c], pa.string()), pa.array(values[:, c], mask=features[:, c] == None))]  # noqa: E711
            yield pa.RecordBatch.from_arrays(
                [table.column("_id").combine_chunks(), table.column("_user").combine_chunks(), pa.array(score), pa.array((score < 0).astype(np.int32)),
                 pa.array(np.repeat(n, n).astype(np.int64)), *told],
                names=[id_col, user, "per_user_score", "per_user_anomaly", "user_model_n_samples", *tops[:len(told)]])

    types = dict(rows.dtypes)
    schema = f"`{id_col}` {types[id_col]}, `{user}` {types[user]}, per_user_score double, per_user_anomaly int, user_model_n_samples long"
    return stream.mapInArrow(task, schema + (f", {_top_schema(min(k, len(columns)))}" if k else ""))


def per_user_scores(df: DataFrame, columns: Sequence[str], id_col: str = "login_id", user: str = "user_id",
                    n_trees: int = 100, n_sub: int = 256, seed: int = 42) -> DataFrame:
    """(id, user, per_user_score, per_user_anomaly, user_model_n_samples).

    The score is the raw score minus the user's own contamination quantile, with
    contamination min(0.1, max(0.01, 5/n)); users with fewer than 20 rows get zeros. A user with few rows is scored
    by one task; the rows of others are put together by id.
    """
    rows = df.select(id_col, user, *[F.col(c).cast("double").alias(c) for c in columns])
    whole, others = _by_user(rows, id_col, user, min(n_trees * n_sub, CHUNK_ROWS))
    out = _score_whole_users(whole, columns, id_col, user, n_trees, n_sub, seed)
    return out if others is None else out.unionByName(_scores_by_id(others, columns, id_col, user, n_trees, n_sub, seed))


def _scores_by_id(df: DataFrame, columns: Sequence[str], id_col: str, user: str, n_trees: int, n_sub: int, seed: int) -> DataFrame:
    jobs = _PerUser(df, columns, id_col, user, n_trees, n_sub, seed)
    raw = jobs.run(lambda f, x: {"raw": anomaly_score(f, x)}, "raw double")
    who = jobs.rows.select(id_col, user, F.col("_n").alias("user_model_n_samples"))
    scored = cut_lineage(who.join(raw, id_col, "left"))
    edges = exact_quantiles(scored, "raw", _contamination(F.col("total")), [user]).select(user, F.col("quantile").alias("_edge"))
    out = lookup(scored, edges, [user])
    score = F.coalesce(F.col("raw") - F.col("_edge"), F.lit(0.0))
    return out.select(id_col, user, score.alias("per_user_score"), F.when(score < 0, 1).otherwise(0).alias("per_user_anomaly"),
                      "user_model_n_samples")


def per_user_fit(df: DataFrame, columns: Sequence[str], id_col: str = "login_id", user: str = "user_id", n_trees: int = 100,
                 n_sub: int = 256, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """What is needed to score later rows: the training sample of each user, and (user, edge, n_samples) with the contamination quantile."""
    return per_user_fit_scores(df, columns, id_col, user, n_trees, n_sub, seed)[:2]


def per_user_fit_scores(df: DataFrame, columns: Sequence[str], id_col: str = "login_id", user: str = "user_id", n_trees: int = 100,
                        n_sub: int = 256, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``per_user_fit``, and the raw scores (id, raw) of the training rows for ``per_user_apply``."""
    jobs = _PerUser(df, columns, id_col, user, n_trees, n_sub, seed)
    samples = cut_lineage(jobs.samples())
    user_type = dict(df.dtypes)[user]
    raw = cut_lineage(jobs.run(lambda f, x: {"raw": anomaly_score(f, x)}, "raw double", jobs.rows.filter(F.col("_n") >= MIN_USER_ROWS), samples))
    scored = cut_lineage(jobs.rows.select(id_col, user).join(raw, id_col))
    edges = exact_quantiles(scored, "raw", _contamination(F.col("total")), [user]).select(user, F.col("quantile").alias("edge"))
    counts = jobs.rows.select(F.col(user).cast(user_type), F.col("_n").alias("n_samples")).distinct()
    return samples, edges.join(counts, user), raw


def per_user_apply(df: DataFrame, samples: DataFrame, edges: DataFrame, columns: Sequence[str], id_col: str = "login_id",
                   user: str = "user_id", n_trees: int = 100, n_sub: int = 256, seed: int = 42, raw: DataFrame | None = None) -> DataFrame:
    """(id, user, per_user_score, per_user_anomaly, user_model_n_samples) of new rows by the stored samples and edges.

    The forest of a user comes from the stored sample and the seed alone, so a row scores the same in any batch. Users without a
    stored model get zeros. ``raw``: the raw scores (id, raw) of these rows by the same samples, where they are known.
    """
    rows = df.select(id_col, user)
    if raw is None:
        jobs = _PerUser(df, columns, id_col, user, n_trees, n_sub, seed)
        raw = jobs.run(lambda f, x: {"raw": anomaly_score(f, x)}, "raw double", jobs.rows, samples)
    out = lookup(rows, edges, [user]).join(raw, id_col, "left")
    score = F.coalesce(F.col("raw") - F.col("edge"), F.lit(0.0))
    return out.select(id_col, user, score.alias("per_user_score"), F.when(score < 0, 1).otherwise(0).alias("per_user_anomaly"),
                      F.coalesce("n_samples", F.lit(0)).alias("user_model_n_samples"))


def per_user_explain(df: DataFrame, scores: DataFrame | None, columns: Sequence[str], k: int = 3, id_col: str = "login_id",
                     user: str = "user_id", n_trees: int = 100, n_sub: int = 256, seed: int = 42,
                     flagged_only: bool = True) -> DataFrame:
    """Scores with the k strongest features of each (flagged) row, from the user's own forest.

    Without ``scores`` they are those of ``per_user_scores``, worked out in the same pass where one task has all rows of a user.
    """
    if scores is None:
        rows = df.select(id_col, user, *[F.col(c).cast("double").alias(c) for c in columns])
        whole, others = _by_user(rows, id_col, user, min(n_trees * n_sub, CHUNK_ROWS))
        out = _score_whole_users(whole, columns, id_col, user, n_trees, n_sub, seed, k, flagged_only)
        if others is None:
            return out
        found = cut_lineage(_scores_by_id(others, columns, id_col, user, n_trees, n_sub, seed))
        return out.unionByName(per_user_explain(others, found, columns, k, id_col, user, n_trees, n_sub, seed, flagged_only))
    jobs = _PerUser(df, columns, id_col, user, n_trees, n_sub, seed)
    wanted = scores.filter("per_user_anomaly = 1") if flagged_only else scores
    rows = jobs.rows.filter(F.col("_n") >= MIN_USER_ROWS).join(wanted.select(id_col), id_col, "left_semi")
    columns = list(columns)

    def work(forest: Forest, x: np.ndarray) -> dict[str, object]:
        return _top_features(forest_attributions(forest, x, len(columns)), columns, k)

    tops = jobs.run(work, _top_schema(k), rows)
    return scores.join(tops, id_col, "left")
