"""Density clusters of vectors of any width, exact, over the blocks of a metric tree.

Equal vectors are one weighted point. Blocks meet only where the triangle inequality leaves a chance of two vectors within
``eps``; a meeting is one bounded numpy task that returns counts, component pairs or one nearest point per vector, never
pairs of vectors. A leaf of radius ``eps / 2`` or less that holds ``min_samples`` rows needs no distances of its own: all its
vectors are core points of one cluster.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.operators.clusters import connected_components
from tarn.operators.neighbours import _close, _distances, _matrix, _pair_distances, _squares, block_groups, metric_tree
from tarn.operators.tails import join_by_value
from tarn.session import cut_lineage, spread

BLOCK_ROWS = 1024
TILE = 4096    # targets at a time
STRIP = 256    # rows whose squares are in hand at once
SLACK = 1e-9  # leaves meet a little beyond eps, so that rounding of their radius loses no pair


def _near_leaves(leaves: pd.DataFrame, centres: dict[int, np.ndarray], eps: float) -> pd.DataFrame:
    """(leaf, target_leaf) that may hold vectors within eps of each other; both are bounded by the number of leaves of the tree."""
    at = np.array([centres[x] for x in leaves["leaf"]])
    r, leaf = leaves["r"].to_numpy(), leaves["leaf"].to_numpy(np.int32)
    home, target = [], []
    for i in range(0, len(at), 64):
        reach = r[i:i + 64, None] + r[None, :] + eps
        h, t = np.nonzero(_distances(at[i:i + 64], at) <= reach * (1 + SLACK) + SLACK)
        home.append(leaf[h + i])
        target.append(leaf[t])
    return pd.DataFrame({"leaf": np.concatenate(home), "target_leaf": np.concatenate(target)})


def _within(x: np.ndarray, y: np.ndarray, eps: float) -> np.ndarray:
    """Which vectors of ``y`` lie within eps of each vector of ``x``; pairs near the limit are decided by plain differences."""
    middle = y.mean(axis=0)
    a, b = x - middle, y - middle
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    size = float(aa.max(initial=0.0)) + float(bb.max(initial=0.0))
    slack = 4 * (a.shape[1] + 8) * float(np.finfo(np.float32).eps) * size + 32 * (a.shape[1] + 8) * np.finfo(float).eps * (
        size + float((middle * middle).sum()))
    if not (1e-20 < size < 1e30 and slack <= 0.01 * eps * eps):  # too coarse in single precision
        d, slack = _squares(x, y)
        out = d <= eps * eps
        i, j = np.nonzero(np.abs(d - eps * eps) <= slack + 1e-12 * eps * eps)
        out[i, j] = _pair_distances(x[i], y[j]) <= eps
        return out
    a, b = a.astype(np.float32), b.astype(np.float32)
    left = np.column_stack([-2 * a, (a * a).sum(axis=1), np.ones(len(a), np.float32)])
    right = np.ascontiguousarray(np.column_stack([b, np.ones(len(b), np.float32), (b * b).sum(axis=1)]).T)
    out = np.empty((len(a), len(b)), bool)
    for i in range(0, len(a), STRIP):
        d = left[i:i + STRIP] @ right
        sure = out[i:i + STRIP]
        np.less_equal(d, np.float32(eps * eps - slack), out=sure)
        r, c = _marks(sure ^ (d <= np.float32(eps * eps + slack)))
        sure[r, c] = _pair_distances(x[r + i], y[c]) <= eps
    return out


def _marks(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few true cells; eight cells are looked at together."""
    flat = np.zeros(-(-found.size // 8) * 8, bool)
    flat[:found.size] = found.ravel()
    eights = np.flatnonzero(flat.view(np.uint64))
    e, bit = np.nonzero(flat.reshape(-1, 8)[eights])
    at = eights[e] * 8 + bit
    return at // found.shape[1], at % found.shape[1]


def _components(near: np.ndarray) -> np.ndarray:
    """The number of the first member of each row's component, by frontiers over a symmetric matrix."""
    label = np.full(len(near), -1)
    for i in range(len(near)):
        if label[i] < 0:
            front = np.array([i])
            label[i] = i
            while len(front):
                reached = near[front].any(axis=0) & (label < 0)
                label[reached] = i
                front = np.flatnonzero(reached)
    return label


def _meet(left: DataFrame, right: DataFrame, pairs: DataFrame, groups: DataFrame, allowed: Callable[[pd.DataFrame, pd.DataFrame], np.ndarray],
          fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` for every block of ``left`` and the blocks of a group of ``right`` that it may meet.

    Groups of blocks meet in one task, as ``pairs`` (home, target) tells; ``allowed(block, others)`` marks the blocks to look at. Both tables have
    the columns leaf and block.
    """
    keys = ["home", "target"]
    a = left.join(F.broadcast(groups), "block").withColumnRenamed("grp", "home").join(F.broadcast(pairs), "home")
    b = right.join(F.broadcast(groups), "block").select(F.col("grp").alias("to_target"), *[F.col(c).alias(c) for c in right.columns]).join(
        F.broadcast(pairs.select(F.col("home").alias("to_home"), F.col("target").alias("to_target"))), "to_target")
    names = [part.split()[0] for part in schema.split(", ")]

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(x) and len(y):
            blocks, which = np.unique(y["block"].to_numpy(), return_inverse=True)
            heads = y.iloc[np.unique(which, return_index=True)[1]][["leaf", "block"]]
            for _, home in x.groupby("block", sort=True):
                wanted = allowed(home[["leaf", "block"]].iloc[:1], heads)
                if wanted.any():
                    found.append(fn(home, y if wanted.all() else y[wanted[which]]))
        found = [f for f in found if len(f)]
        return pd.concat(found, ignore_index=True) if found else pd.DataFrame(columns=names)

    return spread(a, *keys).groupBy(*keys).cogroup(spread(b, "to_home", "to_target").groupBy("to_home", "to_target")).applyInPandas(run, schema)


def density_cluster_vectors(df: DataFrame, eps: float, min_samples: int = 15, min_size: int = 80, id_col: str = "email_id",
                            vec: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, embedding_cluster, cluster_probability), one row for each row of ``df``; ids are whole numbers.

    A core point has ``min_samples`` rows within ``eps`` (Euclidean, itself included); core points within eps of each other share a
    cluster; other rows join the nearest core point in reach, the smaller id on ties; clusters below ``min_size`` rows and all
    other rows are noise, -1. A cluster is named by its smallest core id. Strength is 1 - distance / eps to the
    nearest core point. Vectors that are null or hold a null or NaN are noise; all others must have the same width.

    The result equals comparing all pairs. Work grows with the pairs of blocks within reach: data in which everything lies
    within a few eps of everything else, but not within eps / 2, must compare all blocks.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    whole = F.col("vec").isNotNull() & ~F.coalesce(F.exists("vec", lambda x: x.isNull() | F.isnan(x)), F.lit(False))
    rows = rows.withColumn("vec", F.when(whole, F.col("vec")))
    given = rows.filter("vec IS NOT NULL")
    points = cut_lineage(given.groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("id").cast("long").alias("vid")))
    placed, centres = metric_tree(points.select("vid", "vec"), block_rows=block_rows)
    if not centres:
        return rows.select(F.col("id").alias(id_col), F.lit(-1).cast("long").alias("embedding_cluster"), F.lit(0.0).alias("cluster_probability"))
    placed = placed.join(points.select("vid", "n"), "vid")
    leaves = placed.groupBy("leaf").agg(F.max("radius").alias("r"), F.count(F.lit(1)).alias("c"), F.sum("n").alias("rows"),
                                        F.min("vid").alias("least")).orderBy("leaf").toPandas()
    leaves["dense"] = (2 * leaves["r"] <= eps * (1 - SLACK)) & (leaves["rows"] >= min_samples)
    leaves["lanes"] = np.maximum(1, -(-leaves["c"] // block_rows))
    about = spark.createDataFrame(leaves[["leaf", "dense", "lanes", "least"]], "leaf int, dense boolean, lanes int, least long")
    blocks = cut_lineage(placed.join(F.broadcast(about), "leaf").select(
        "vid", "vec", "n", "leaf", "dense", "least", F.concat_ws("_", "leaf", F.pmod(F.xxhash64("vid"), F.col("lanes"))).alias("block")))
    near = _near_leaves(leaves, centres, eps)
    numbers = leaves["leaf"].to_numpy()
    reach = np.zeros((len(numbers), len(numbers)), bool)
    reach[np.searchsorted(numbers, near["leaf"]), np.searchsorted(numbers, near["target_leaf"])] = True
    shared = spark.sparkContext.broadcast((numbers, reach, leaves["dense"].to_numpy()))
    groups = cut_lineage(block_groups(blocks, len(next(iter(centres.values()))), block_rows))
    in_group = blocks.select("leaf", "block", "dense").distinct().join(F.broadcast(groups), "block").select("leaf", "grp", "dense").distinct()
    met = spark.createDataFrame(near, "leaf int, target_leaf int")
    pairs = cut_lineage(in_group.select("leaf", F.col("grp").alias("home"), F.col("dense").alias("home_dense")).join(met, "leaf").join(
        in_group.select(F.col("leaf").alias("target_leaf"), F.col("grp").alias("target")), "target_leaf").select("home", "target", "home_dense").distinct())

    def in_reach(home: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
        numbers, reach, _ = shared.value
        return reach[np.searchsorted(numbers, home["leaf"].iloc[0]), np.searchsorted(numbers, others["leaf"])]

    def across_blocks(home: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
        """Each pair of blocks once; the blocks of a dense leaf belong together anyway."""
        numbers, _, dense = shared.value
        leaf, block = home["leaf"].iloc[0], home["block"].iloc[0]
        together = (others["leaf"].to_numpy() == leaf) & dense[np.searchsorted(numbers, leaf)]
        return in_reach(home, others) & (others["block"] > block).to_numpy() & ~together

    def crowd(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        n, q, t, counts = y["n"].to_numpy(np.int64), _matrix(x["vec"]), _matrix(y["vec"]), np.zeros(len(x), np.int64)
        for i in range(0, len(y), TILE):
            near, copies = _within(q, t[i:i + TILE], eps), n[i:i + TILE]
            counts += np.count_nonzero(near, axis=1) if (copies == 1).all() else near @ copies
        return pd.DataFrame({"vid": x["vid"], "crowd": counts})

    def at_home(pdf: pd.DataFrame) -> pd.DataFrame:
        return crowd(pdf, pdf)

    # a vector that has enough rows around it in its own block is a core point; only the others meet further blocks
    open_ = blocks.filter(~F.col("dense")).select("vid", "vec", "leaf", "block")
    inside = cut_lineage(spread(blocks.filter(~F.col("dense")), "block").groupBy("block").applyInPandas(at_home, "vid long, crowd long"))
    sure = inside.filter(F.col("crowd") >= min_samples).select("vid")
    unsure = open_.join(sure, "vid", "left_anti")
    of_thin = pairs.filter(~F.col("home_dense")).select("home", "target").distinct()
    counted = _meet(unsure, blocks.select("vec", "n", "leaf", "block"), of_thin, groups, in_reach, crowd, "vid long, crowd long")
    core_ids = counted.groupBy("vid").agg(F.sum("crowd").alias("crowd")).filter(F.col("crowd") >= min_samples).select("vid")
    core_ids = cut_lineage(core_ids.union(sure).union(blocks.filter("dense").select("vid")))
    core = blocks.join(core_ids, "vid")

    def parts(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vid")
        if pdf["dense"].iloc[0]:
            return pdf[["vid", "vec", "leaf", "block"]].assign(part=pdf["least"])
        return pdf[["vid", "vec", "leaf", "block"]].assign(part=pdf["vid"].to_numpy()[_components(_within(_matrix(pdf["vec"]), _matrix(pdf["vec"]), eps))])

    core = cut_lineage(spread(core, "block").groupBy("block").applyInPandas(parts, "vid long, vec array<double>, leaf int, block string, part long"))

    def links(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        names_a, a = np.unique(x["part"].to_numpy(), return_inverse=True)
        names_b, b = np.unique(y["part"].to_numpy(), return_inverse=True)
        found = np.zeros((len(names_a), len(names_b)), bool)
        q, t = _matrix(x["vec"]), _matrix(y["vec"])
        for j in range(0, len(y), TILE):
            parts_here = np.unique(b[j:j + TILE])
            for i in range(0, len(x), STRIP):  # until all parts are linked: a few rows are enough for parts that lie in each other
                r, c = _marks(_within(q[i:i + STRIP], t[j:j + TILE], eps))
                found[a[i + r], b[j + c]] = True
                if found[:, parts_here].all():
                    break
        r, c = np.nonzero(found)
        return pd.DataFrame({"a": names_a[r], "b": names_b[c]})

    side = core.select("vec", "part", "leaf", "block")
    edges = _meet(side, side, pairs.select("home", "target").distinct(), groups, across_blocks, links, "a long, b long").filter("a <> b")
    named = connected_components(core.select(F.col("part").alias("node")).distinct(), edges)
    named = cut_lineage(named.select(F.col("node").alias("part"), F.col("component").alias("cluster")))

    def nearest(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        q, t, ids, found = _matrix(x["vec"]), _matrix(y["vec"]), y["vid"].to_numpy(), []
        for j in range(0, len(y), TILE):
            for r, c in _close(q, t[j:j + TILE], np.full(len(q), eps * eps * (1 + 1e-12)), None):
                found.append((r, j + c, _pair_distances(q[r], t[j + c])))
        if not found:
            return pd.DataFrame({"vid": [], "dist": [], "to": [], "part": []})
        r, c, dist = (np.concatenate(v) for v in zip(*found))
        order = np.lexsort((ids[c], dist, r))
        r, c, dist = r[order], c[order], dist[order]
        first = np.r_[True, r[1:] != r[:-1]] & (dist <= eps) if len(r) else np.zeros(0, bool)
        r, c, dist = r[first], c[first], dist[first]
        return pd.DataFrame({"vid": x["vid"].to_numpy()[r], "dist": dist, "to": ids[c], "part": y["part"].to_numpy()[c]})

    rest = open_.join(core_ids, "vid", "left_anti")
    reached = _meet(rest, core.select("vid", "vec", "part", "leaf", "block"), of_thin, groups, in_reach, nearest,
                    "vid long, dist double, to long, part long")
    border = reached.groupBy("vid").agg(F.min(F.struct("dist", "to", "part")).alias("m")).select("vid", "m.part", "m.dist")
    member = cut_lineage(core.select("vid", "part", F.lit(0.0).alias("dist")).unionByName(border).join(named, "part").join(points.select("vid", "n"), "vid"))
    sizes = member.groupBy("cluster").agg(F.sum("n").alias("size")).filter(F.col("size") >= min_size).select("cluster")
    kept = member.join(sizes, "cluster").select("vid", F.struct("cluster", (1 - F.col("dist") / eps).alias("strength")).alias("found"))
    total = points.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t")).scalar()
    found = points.join(kept, "vid", "left").select("vec", "n", total.alias("total"), "found")
    out = join_by_value(given, found, ["vec"]).select("id", "found").unionByName(
        rows.filter("vec IS NULL").select("id", F.lit(None).cast("struct<cluster: bigint, strength: double>").alias("found")))
    return out.select(F.col("id").alias(id_col), F.coalesce("found.cluster", F.lit(-1).cast("long")).alias("embedding_cluster"),
                      F.coalesce("found.strength", F.lit(0.0)).alias("cluster_probability"))
