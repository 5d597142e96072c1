"""Exact nearest neighbours by a metric tree, and the scores built on them.

Vectors are reduced to distinct ones, so any number of exact copies costs one
row. Every vector goes down a tree of vantage points to a leaf with a centre and a
radius of its own, which holds a bounded block of vectors. Blocks meet only when the
triangle inequality cannot rule it out, in groups of bounded size. A group first meets itself,
which bounds the reach of its vectors; then each pair of groups meets once, for both sides, in one bounded numpy
task that returns at most k neighbours per vector. No pair of vectors is ever emitted just to be filtered later.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.operators.tails import join_by_value
from tarn.session import cut_lineage, spread

BLOCK_ROWS = 2048
TILE_BYTES = 16 << 20  # vectors of a group of blocks; two groups meet in a task
TILE_SHARE = 8         # groups at least, if there are as many blocks
LANES = 2              # partitions for each pair of groups, so that hardly a task gets several of them
MAX_LANES = 2000       # but no more partitions than this
MAX_PIVOTS = 256
MAX_LEAVES = 2048
FAN = 32
TINY = 1e-10
STRIP = 256    # rows of a tile whose squares are in hand at once
SLACK = 1e-9   # balls reach a little further, so that rounding loses no pair


def distinct_vectors(df: DataFrame, id_col: str, vec: str, k: int) -> DataFrame:
    """(vid, vec, n, ids): one row per distinct vector, its smallest id, copies and k+1 smallest ids."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    counted = rows.groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("vid"))
    first = Window.partitionBy("vec").orderBy("id")
    few = rows.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= k + 1)
    members = few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return counted.join(members, "vec").select("vid", "vec", "n", "ids")


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise Euclidean distances by plain differences (no cancellation), tile by tile."""
    out = np.empty((len(a), len(b)))
    step = max(1, int(4_000_000 / max(1, b.size)))
    for i in range(0, len(a), step):
        diff = a[i:i + step, None, :] - b[None, :, :]
        out[i:i + step] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    return out


def _squares(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances as one matrix product, and a bound of what rounding can have changed. Only for sorting out: what
    lies within the bound of a limit is to be decided by ``_pair_distances``. Rows that are not finite give NaN or infinity."""
    whole_a, whole_b = np.isfinite(a).all(axis=1), np.isfinite(b).all(axis=1)
    middle = b[whole_b].mean(axis=0) if whole_b.any() else np.zeros(b.shape[1])
    a, b = a - middle, b - middle
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    out = a @ b.T
    out *= -2.0
    out += aa[:, None]
    out += bb[None, :]
    size = float(aa[whole_a].max(initial=0.0)) + float(bb[whole_b].max(initial=0.0)) + float((middle * middle).sum())
    return out, 32 * (a.shape[1] + 8) * np.finfo(float).eps * size


def _pair_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of row i of ``a`` and row i of ``b`` by plain differences."""
    out = np.empty(len(a))
    step = max(1, 4_000_000 // max(1, a.shape[1]))
    for i in range(0, len(a), step):
        diff = a[i:i + step] - b[i:i + step]
        out[i:i + step] = np.sqrt(np.einsum("ik,ik->i", diff, diff))
    return out


def _own_reach(x: np.ndarray, k: int) -> np.ndarray:
    """An upper bound of every vector's distance to its k-th nearest other vector of the block."""
    if len(x) <= k:
        return np.full(len(x), np.inf)
    d, slack = _squares(x, x)
    np.fill_diagonal(d, np.inf)
    reach = np.sqrt(np.maximum(np.partition(d, k - 1, axis=1)[:, k - 1], 0.0) + slack)
    return np.where(np.isnan(reach), np.inf, reach)


def _close(a: np.ndarray, b: np.ndarray, row_limit: np.ndarray | None, col_limit: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of ``a``, rows of ``b``) whose squared distance may be within the row's limit or the column's; no pair within one is left out.

    The squares come from one matrix product per tile, in single precision where its rounding is small against the limits.
    """
    limits = [x for x in (row_limit, col_limit) if x is not None]
    middle = b.mean(axis=0)
    with np.errstate(all="ignore"):
        x, y = a - middle, b - middle
        xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
        size = float(xx.max(initial=0.0)) + float(yy.max(initial=0.0))
        slack = 32 * (a.shape[1] + 8) * np.finfo(float).eps * (size + float((middle * middle).sum()))
        single = slack + 4 * (a.shape[1] + 8) * float(np.finfo(np.float32).eps) * size
    if not np.isfinite(slack):  # vectors that hold infinity or NaN, or overflow
        for i in range(0, len(a), STRIP):
            d, slack = _squares(a[i:i + STRIP], b)
            keep = np.zeros(d.shape, bool)
            if row_limit is not None:
                keep |= d <= row_limit[i:i + STRIP, None] + slack
            if col_limit is not None:
                keep |= d <= col_limit[None, :] + slack
            r, c = np.nonzero(keep)
            yield r + i, c
        return
    kind, slack = (np.float32, single) if 1e-20 < size < 1e30 and single <= 0.01 * min(float(np.median(v)) for v in limits) else (float, slack)
    x, y = x.astype(kind), y.astype(kind)
    xx, yy = np.einsum("ij,ij->i", x, x, dtype=float), np.einsum("ij,ij->i", y, y, dtype=float)
    left = np.column_stack([-2 * x, xx, np.ones(len(x))]).astype(kind)  # left @ right = squares
    right = np.ascontiguousarray(np.column_stack([y, np.ones(len(y)), yy]).astype(kind).T)
    rows, cols = ((None if v is None else (v + slack).astype(kind)) for v in (row_limit, col_limit))
    d, keep, more = np.empty((STRIP, len(b)), kind), np.zeros(-(-STRIP * len(b) // 8) * 8, bool), np.empty((STRIP, len(b)), bool)
    for i in range(0, len(a), STRIP):
        n = min(STRIP, len(a) - i)
        np.matmul(left[i:i + n], right, out=d[:n])
        here = keep[:n * len(b)].reshape(n, len(b))
        keep[n * len(b):] = False
        if rows is None:
            np.less_equal(d[:n], cols[None, :], out=here)
        else:
            np.less_equal(d[:n], rows[i:i + n, None], out=here)
            if cols is not None:
                np.logical_or(here, np.less_equal(d[:n], cols[None, :], out=more[:n]), out=here)
        eights = np.flatnonzero(keep.view(np.uint64))  # few pairs are kept, so eight marks are looked at together
        if len(eights):
            e, bit = np.nonzero(keep.reshape(-1, 8)[eights])
            flat = eights[e] * 8 + bit
            yield flat // len(b) + i, flat % len(b)


class _Nearest:
    """The k nearest targets of every query by (distance, id), kept while block after block of targets is looked at.

    Pairs found are noted and merged when there are many, so that the reach of the queries shrinks on the way.
    """

    def __init__(self, ids: np.ndarray, q: np.ndarray, reach: np.ndarray, k: int):
        self.ids, self.q, self.reach, self.k = ids, q, reach.copy(), k
        self.row, self.nbr, self.dist = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.noted: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def within(self, rows: np.ndarray, centre: np.ndarray, low: float, high: float) -> np.ndarray:
        """Those of ``rows`` that may have neighbours in a ball, whose members are between ``low`` and ``high`` from its centre."""
        near = _distances(self.q[rows], centre[None, :])[:, 0]
        reach = self.reach[rows] + SLACK * (near + high)
        return rows[(near - high <= reach) & (low - near <= reach)]

    def limit(self, rows: np.ndarray) -> np.ndarray:
        return np.square(self.reach[rows]) * (1 + 1e-12)

    def look(self, ids: np.ndarray, t: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> None:
        rows = self.within(np.arange(len(self.ids)), centre, np.nanmin(radius), np.nanmax(radius))
        bounded = np.isfinite(self.reach[rows])
        self._first(rows[~bounded], ids, t)
        rows = rows[bounded]
        if len(rows):
            for r, c in _close(self.q[rows], t, self.limit(rows), None):
                self.note(rows[r], ids[c], _pair_distances(self.q[rows[r]], t[c]))

    def _first(self, rows: np.ndarray, ids: np.ndarray, t: np.ndarray) -> None:
        """Targets for queries without a bound: the k + 1 nearest, as the query itself may be among them."""
        step = max(1, 8_000_000 // max(1, len(t)))
        for i in range(0, len(rows), step):
            at = rows[i:i + step]
            d, slack = _squares(self.q[at], t)
            limit = np.full((len(at), 1), np.inf)
            if len(t) > self.k + 1:
                limit = np.minimum(limit, np.partition(d, self.k, axis=1)[:, self.k:self.k + 1] + 2 * slack)
            r, c = np.nonzero(d <= limit)
            self.note(at[r], ids[c], _pair_distances(self.q[at[r]], t[c]))
        if len(rows):
            self.merge()

    def note(self, row: np.ndarray, nbr: np.ndarray, dist: np.ndarray) -> None:
        keep = (self.ids[row] != nbr) & (dist <= self.reach[row] * (1 + 1e-12))
        self.noted.append((row[keep], nbr[keep], dist[keep]))
        self.waiting += int(keep.sum())
        if self.waiting > max(1 << 16, len(self.ids) * self.k // 2):
            self.merge()

    def merge(self) -> None:
        if not self.noted:
            return
        row, nbr, dist = (np.concatenate(x) for x in zip(*self.noted))
        self.noted, self.waiting = [], 0
        touched = np.zeros(len(self.ids), bool)
        touched[row] = True
        own = touched[self.row]
        row, nbr, dist = np.r_[self.row[own], row], np.r_[self.nbr[own], nbr], np.r_[self.dist[own], dist]
        order = np.lexsort((nbr, dist, row))
        row, nbr, dist = row[order], nbr[order], dist[order]
        first = np.searchsorted(row, row)
        keep = np.arange(len(row)) - first < self.k
        row, nbr, dist, place = row[keep], nbr[keep], dist[keep], (np.arange(len(row)) - first)[keep]
        last = place == self.k - 1
        self.reach[row[last]] = np.minimum(self.reach[row[last]], dist[last])
        self.row, self.nbr, self.dist = np.r_[self.row[~own], row], np.r_[self.nbr[~own], nbr], np.r_[self.dist[~own], dist]

    def found(self) -> pd.DataFrame:
        self.merge()
        return pd.DataFrame({"vid": self.ids[self.row], "nbr": self.nbr, "dist": self.dist})

    def lists(self) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """The queries that found something, and the ids and distances of what they found."""
        self.merge()
        order = np.argsort(self.row, kind="stable")
        row, start = np.unique(self.row[order], return_index=True)
        return row, np.split(self.nbr[order], start[1:]) if len(row) else [], np.split(self.dist[order], start[1:]) if len(row) else []


class _Group(_Nearest):
    """The vectors of a group of blocks, block by block, each with its ball."""

    def __init__(self, pdf: pd.DataFrame, reach: np.ndarray, k: int, centres: dict[int, np.ndarray]):
        super().__init__(pdf["vid"].to_numpy(), _matrix(pdf["vec"]), reach, k)
        radius = pdf["radius"].to_numpy()
        self.blocks = []
        for rows in pdf.groupby("block", sort=True).indices.values():
            self.blocks.append((rows, centres[int(pdf["leaf"].iloc[rows[0]])], np.nanmin(radius[rows]), np.nanmax(radius[rows])))

    def meet_itself(self) -> None:
        for i, (rows, *_) in enumerate(self.blocks):
            for other, *ball in self.blocks[:i]:
                self._pair(rows, self.blocks[i][1:], self, other, ball)
            bounded = np.isfinite(self.reach[rows])
            self._first(rows[~bounded], self.ids[rows], self.q[rows])
            mine = rows[bounded]
            if len(mine):
                for r, c in _close(self.q[mine], self.q[rows], self.limit(mine), None):
                    self.note(mine[r], self.ids[rows[c]], _pair_distances(self.q[mine[r]], self.q[rows[c]]))

    def meet(self, other: _Group) -> None:
        for rows, *ball in self.blocks:
            for targets, *target_ball in other.blocks:
                self._pair(rows, ball, other, targets, target_ball)

    def _pair(self, rows: np.ndarray, ball: list, other: _Group, targets: np.ndarray, target_ball: list) -> None:
        """Two blocks look at each other: by one product if most of both may be in reach."""
        mine, its = self.within(rows, *target_ball), other.within(targets, *ball)
        for a, x, b, y in ((self, mine, other, targets), (other, its, self, rows)):
            free = x[~np.isfinite(a.reach[x])]
            a._first(free, b.ids[y], b.q[y])
            if len(free):  # seen; the bound they got is for other blocks
                x = x[~np.isin(x, free)]
            if a is self and y is targets:
                mine = x
            else:
                its = x
        if len(mine) * len(targets) + len(rows) * len(its) > len(rows) * len(targets):
            row_limit, col_limit = np.zeros(len(rows)) - 1, np.zeros(len(targets)) - 1
            row_limit[np.searchsorted(rows, mine)] = self.limit(mine)
            col_limit[np.searchsorted(targets, its)] = other.limit(its)
            for r, c in _close(self.q[rows], other.q[targets], row_limit, col_limit):
                r, c = rows[r], targets[c]
                dist = _pair_distances(self.q[r], other.q[c])
                self.note(r, other.ids[c], dist)
                other.note(c, self.ids[r], dist)
            return
        if len(mine):
            for r, c in _close(self.q[mine], other.q[targets], self.limit(mine), None):
                self.note(mine[r], other.ids[targets[c]], _pair_distances(self.q[mine[r]], other.q[targets[c]]))
        if len(its):
            for r, c in _close(self.q[rows], other.q[its], None, other.limit(its)):
                other.note(its[c], self.ids[rows[r]], _pair_distances(self.q[rows[r]], other.q[its[c]]))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


def _place(rows: DataFrame, centres: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Move the rows of each leaf in ``centres`` to the nearest of its new leaves: leaf -> (their numbers, their centres)."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for leaf, part in pdf.groupby("leaf"):
                if leaf in shared.value:
                    numbers, x = shared.value[leaf]
                    d = _distances(_matrix(part["vec"]), x)
                    part = part.assign(leaf=numbers[d.argmin(axis=1)], radius=d.min(axis=1))
                yield part

    return rows.mapInPandas(run, "vid long, vec array<double>, leaf int, radius double")


def metric_tree(vectors: DataFrame, seed: int = 42, block_rows: int = BLOCK_ROWS, pivots: int | None = None,
                most: int = MAX_LEAVES) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """(vid, vec, leaf, radius) and the centre of each leaf.

    Leaves that hold more than ``block_rows`` vectors are split again and again by vantage points drawn from their own members, each
    vector going to the nearest one, so that a leaf covers a small ball. At most ``most`` centres are kept on the driver; a leaf
    that is still too large then, or that no point splits, is cut by hash later.
    """
    n = vectors.count()
    first = pivots or max(1, min(MAX_PIVOTS, int(math.sqrt(n) / 4)))
    # vectors are few bytes for much work, so they are dealt over a fixed count of partitions
    rows = spread(vectors.select("vid", "vec", F.lit(0).alias("leaf"), F.lit(0.0).alias("radius")), "vid")
    centres: dict[int, np.ndarray] = {}
    large = {0: first}
    following = 0
    while large:
        fan = F.lit(0)
        for leaf, f in large.items():
            fan = F.when(F.col("leaf") == leaf, f).otherwise(fan) if len(large) <= 64 else fan
        if len(large) > 64:
            wanted = vectors.sparkSession.createDataFrame(list(large.items()), "leaf int, fan int")
            drawn = rows.join(F.broadcast(wanted), "leaf")
        else:
            drawn = rows.withColumn("fan", fan).filter("fan > 0")
        order = Window.partitionBy("leaf").orderBy(F.xxhash64("vid", F.lit(seed + following)), "vid")
        chosen = drawn.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= max(large.values())).filter("_rn <= fan").select("leaf", "_rn", "vec").collect()
        split: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for leaf in large:
            x = np.array([r["vec"] for r in sorted((r for r in chosen if r["leaf"] == leaf), key=lambda r: r["_rn"])], dtype=float)
            numbers = np.arange(following + 1, following + 1 + len(x))
            following += len(x)
            if len(x):
                split[leaf] = numbers, x
                centres.pop(leaf, None)
                centres |= dict(zip(numbers.tolist(), x))
        if not split:
            break
        rows = cut_lineage(_place(rows, split))
        sizes = {r["leaf"]: r["c"] for r in rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("c")).collect()}
        room = most - len(centres)
        new = {int(x) for numbers, _ in split.values() for x in numbers}
        large = {}
        for leaf in sorted(new & sizes.keys(), key=lambda x: (-sizes[x], x)):  # a leaf that did not get smaller is not split again
            fan_out = min(FAN, -(-2 * sizes[leaf] // block_rows))
            if sizes[leaf] > block_rows and sizes[leaf] < n and room >= fan_out:
                large[leaf] = fan_out
                room -= fan_out
        n = max((sizes[x] for x in large), default=0) + 1
    return rows, centres


def meetings(bounded: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """(home, target): the blocks that may hold neighbours of vectors of a block, by the triangle inequality between leaves."""
    spark = bounded.sparkSession
    info = bounded.groupBy("leaf").agg(F.max("radius").alias("r"), F.max(F.col("radius") + F.col("reach")).alias("need")).orderBy("leaf").toPandas()
    at = np.array([centres[x] for x in info["leaf"]])
    r, need = info["r"].to_numpy(), info["need"].to_numpy()
    near = np.concatenate([_distances(at[i:i + 64], at) <= (r[None, :] + need[i:i + 64, None]) * (1 + SLACK) for i in range(0, len(at), 64)])
    home, target = np.nonzero(near)
    leaf = info["leaf"].to_numpy(np.int32)
    links = spark.createDataFrame(pd.DataFrame({"leaf": leaf[home], "target_leaf": leaf[target]}), "leaf int, target_leaf int")
    blocks = bounded.select("leaf", "block").distinct()
    return blocks.join(links, "leaf").select(F.col("block").alias("home"), "target_leaf").join(
        blocks.select(F.col("leaf").alias("target_leaf"), F.col("block").alias("target")), "target_leaf").select("home", "target")


def block_groups(blocks: DataFrame, width: int, block_rows: int) -> DataFrame:
    """(block, grp): neighbouring blocks, in the order of their leaves, in groups of a bounded number of vectors. One row per block."""
    listed = blocks.groupBy("leaf", "block").agg(F.count(F.lit(1)).alias("c")).orderBy("leaf", "block").toPandas()
    before = listed["c"].cumsum() - listed["c"]
    rows = max(block_rows, min(TILE_BYTES // (8 * max(1, width)), -(-int(listed["c"].sum()) // TILE_SHARE)))
    return blocks.sparkSession.createDataFrame(pd.DataFrame({"block": listed["block"], "grp": (before // rows).astype("int32")}), "block string, grp int")


def _lanes(tasks: int) -> int:
    """Partitions for so many heavy groups."""
    return min(MAX_LANES, LANES * tasks)


def vector_neighbours(vectors: DataFrame, k: int, seed: int = 42, block_rows: int = BLOCK_ROWS,
                      pivots: int | None = None) -> DataFrame:
    """(vid, nbr, dist, rank): the k nearest other vectors of each distinct vector, ties by id."""
    spark = vectors.sparkSession
    placed, centres = metric_tree(vectors, seed, block_rows, pivots)
    if not centres:
        return spark.createDataFrame([], "vid long, nbr long, dist double, rank int")
    large = {r["leaf"]: -(-r["c"] // block_rows) for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > block_rows).collect()}
    lanes = spark.createDataFrame([(int(a), int(b)) for a, b in large.items()], "leaf int, lanes int")
    placed = placed.join(F.broadcast(lanes), "leaf", "left").withColumn(
        "block", F.concat_ws("_", "leaf", F.pmod(F.xxhash64("vid"), F.coalesce("lanes", F.lit(1))))).drop("lanes")

    groups = block_groups(placed, len(next(iter(centres.values()))), block_rows)
    shared = spark.sparkContext.broadcast(centres)

    def at_home(pdf: pd.DataFrame) -> pd.DataFrame:
        x, reach = _matrix(pdf["vec"]), np.full(len(pdf), np.inf)
        for rows in pdf.groupby("block").indices.values():
            reach[rows] = _own_reach(x[rows], k)
        group = _Group(pdf, reach, k, shared.value)
        group.meet_itself()
        row, nbr, dist = group.lists()
        out = pdf.assign(reach=group.reach, nbr=None, dist=None)
        out["nbr"], out["dist"] = (pd.Series(x, index=out.index[row], dtype=object).reindex(out.index) for x in (nbr, dist))
        return out

    kinds = "vid long, vec array<double>, leaf int, radius double, block string, grp int, reach double, nbr array<long>, dist array<double>"
    grouped = placed.select("vid", "vec", "leaf", "radius", "block").join(F.broadcast(groups), "block").select(
        "vid", "vec", "leaf", "radius", "block", "grp")
    home = cut_lineage(spread(grouped, "grp", least=_lanes(groups.agg(F.max("grp") + 1).first()[0])).groupBy("grp").applyInPandas(at_home, kinds))
    bounded = home.drop("nbr", "dist")
    linked = meetings(bounded, centres).join(F.broadcast(groups.withColumnsRenamed({"block": "home", "grp": "home_grp"})), "home").join(
        F.broadcast(groups.withColumnsRenamed({"block": "target", "grp": "target_grp"})), "target").filter("home_grp <> target_grp")
    pairs = cut_lineage(linked.select(F.least("home_grp", "target_grp").alias("home"), F.greatest("home_grp", "target_grp").alias("target")).distinct())

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series(dtype=object) for c in ("vid", "nbr", "dist")})
        a, b = (_Group(x, x["reach"].to_numpy(), k, shared.value) for x in (left, right))
        a.meet(b)
        return pd.concat([pd.DataFrame({"vid": x.ids[row], "nbr": pd.Series(nbr, dtype=object), "dist": pd.Series(dist, dtype=object)})
                          for x in (a, b) for row, nbr, dist in [x.lists()]], ignore_index=True)

    columns = [F.col(c).alias(c) for c in ("vid", "vec", "leaf", "radius", "block", "reach")]
    left = bounded.select(F.col("grp").alias("home"), *columns).join(F.broadcast(pairs), "home")
    right = bounded.select(F.col("grp").alias("to_target"), *columns).join(
        F.broadcast(pairs.select(F.col("home").alias("to_home"), F.col("target").alias("to_target"))), "to_target")
    lanes = _lanes(pairs.count())
    met = spread(left, "home", "target", least=lanes).groupBy("home", "target")
    found = met.cogroup(spread(right, "to_home", "to_target", least=lanes).groupBy("to_home", "to_target")).applyInPandas(
        meet, "vid long, nbr array<long>, dist array<double>")
    lists = found.unionByName(home.select("vid", "nbr", "dist").filter("nbr IS NOT NULL")).select("vid", F.arrays_zip("dist", "nbr").alias("found"))
    best = lists.groupBy("vid").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("found"))
    return best.select("vid", F.posexplode("found").alias("pos", "e")).select(
        "vid", F.col("e.nbr").alias("nbr"), F.col("e.dist").alias("dist"), (F.col("pos") + 1).alias("rank"))


def weighted_neighbours(vectors: DataFrame, edges: DataFrame, k: int) -> DataFrame:
    """(vid, nbr, dist, w): how many of the k nearest rows of a vector are copies of each neighbour.

    The vector's own further copies come first, at distance 0.
    """
    own = vectors.filter("n > 1").select("vid", F.col("vid").alias("nbr"), F.lit(0.0).alias("dist"),
                                         (F.col("n") - 1).alias("copies"))
    others = edges.join(vectors.select(F.col("vid").alias("nbr"), F.col("n").alias("copies")), "nbr").select(
        "vid", "nbr", "dist", "copies")
    w = Window.partitionBy("vid").orderBy("dist", "nbr").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("copies").over(w), F.lit(0))
    out = own.unionByName(others).withColumn("w", F.least("copies", F.lit(k) - before))
    return out.filter("w > 0").drop("copies")


def _per_row(df: DataFrame, id_col: str, vec: str, vectors: DataFrame, scores: DataFrame, name: str) -> DataFrame:
    """Give every row the score of its vector."""
    rows = df.select(id_col, F.col(vec).cast("array<double>").alias("vec"))
    total = vectors.agg(F.sum("n").alias("t")).scalar()
    reference = vectors.select("vid", "vec", "n").join(scores, "vid", "left").withColumn("total", total)
    return join_by_value(rows, reference.select("vec", "n", "total", name), ["vec"]).select(id_col, name)


def neighbour_scores(df: DataFrame, id_col: str, vec: str, knn: int = 10, lof: int = 20) -> DataFrame:
    """(id, knn, lof) from one search: the nearest 20 rows contain the nearest 10."""
    k = max(knn, lof)
    vectors = cut_lineage(distinct_vectors(df, id_col, vec, k))
    edges = cut_lineage(vector_neighbours(vectors, k))
    close = weighted_neighbours(vectors, edges.filter(F.col("rank") <= knn).drop("rank"), knn)
    far = cut_lineage(weighted_neighbours(vectors, edges.filter(F.col("rank") <= lof).drop("rank"), lof))
    means = close.groupBy("vid").agg((F.sum(F.col("dist") * F.col("w")) / F.sum("w")).alias("knn"))
    both = means.join(lof_from_neighbours(far), "vid", "full").select("vid", F.struct("knn", "lof").alias("both"))
    return _per_row(df, id_col, vec, vectors, both, "both").select(id_col, "both.knn", "both.lof")


def knn_score(df: DataFrame, id_col: str, vec: str, k: int = 10) -> DataFrame:
    """(id, knn): mean distance to the k nearest other rows."""
    vectors = cut_lineage(distinct_vectors(df, id_col, vec, k))
    near = weighted_neighbours(vectors, vector_neighbours(vectors, k), k)
    scores = near.groupBy("vid").agg((F.sum(F.col("dist") * F.col("w")) / F.sum("w")).alias("knn"))
    return _per_row(df, id_col, vec, vectors, scores, "knn")


def lof_score(df: DataFrame, id_col: str, vec: str, k: int = 20) -> DataFrame:
    """(id, lof): local outlier factor from the weighted neighbour rows."""
    vectors = cut_lineage(distinct_vectors(df, id_col, vec, k))
    near = cut_lineage(weighted_neighbours(vectors, vector_neighbours(vectors, k), k))
    return _per_row(df, id_col, vec, vectors, lof_from_neighbours(near), "lof")


def lof_from_neighbours(near: DataFrame) -> DataFrame:
    reach = near.groupBy("vid").agg(F.max("dist").alias("k_dist"))
    with_reach = near.join(reach.withColumnRenamed("vid", "nbr"), "nbr")
    density = with_reach.groupBy("vid").agg(
        (F.sum("w") / (F.sum(F.greatest("dist", "k_dist") * F.col("w")) + F.lit(TINY))).alias("lrd"))
    ratio = near.join(density.select(F.col("vid").alias("nbr"), F.col("lrd").alias("nbr_lrd")), "nbr").groupBy("vid").agg(
        (F.sum(F.col("nbr_lrd") * F.col("w")) / F.sum("w")).alias("nbr_mean"))
    return ratio.join(density, "vid").select("vid", (F.col("nbr_mean") / F.col("lrd")).alias("lof"))


def knn_edges(df: DataFrame, id_col: str, vec: str, k: int = 10) -> DataFrame:
    """(id, nbr, dist, rank) between rows, ties by id. Lists hold at most k*k+k+1 entries."""
    vectors = cut_lineage(distinct_vectors(df, id_col, vec, k))
    edges = vector_neighbours(vectors, k)
    pair = lambda d: F.transform("ids", lambda i: F.struct(d.alias("dist"), i.alias("nbr")))
    own = vectors.select("vid", pair(F.lit(0.0)).alias("found"))
    others = edges.join(vectors.select(F.col("vid").alias("nbr"), "ids"), "nbr").select("vid", pair(F.col("dist")).alias("found"))
    lists = own.unionByName(others).groupBy("vid").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k + 1).alias("found"))
    near = _per_row(df, id_col, vec, vectors, lists, "found")
    mine = F.slice(F.filter("found", lambda e: e["nbr"] != F.col(id_col)), 1, k)
    return near.select(id_col, F.posexplode(mine).alias("pos", "e")).select(
        F.col(id_col).alias("id"), F.col("e.nbr").alias("nbr"), F.col("e.dist").alias("dist"), (F.col("pos") + 1).alias("rank"))
