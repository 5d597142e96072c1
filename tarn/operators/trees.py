"""Isolation trees as flat numpy arrays: growing, path lengths, attributions.

Small numeric helpers used inside Spark tasks; they only ever see bounded samples
or one Arrow batch of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

EULER = 0.5772156649
TABLE_ROWS = 256   # from so many rows on attributions are looked up
TABLE_DEPTH = 8    # comparisons of a path that make up the key of a table


def mean_path(n: np.ndarray) -> np.ndarray:
    """Average path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    out = 2.0 * (np.log(big - 1.0) + EULER) - 2.0 * (big - 1.0) / big
    return np.where(n >= 3, out, np.where(n >= 2, 1.0, 0.0))


@dataclass
class Forest:
    tree: np.ndarray
    parent: np.ndarray
    feature: np.ndarray      # -1 at a leaf
    threshold: np.ndarray    # rows with x <= threshold go left
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray
    depth: np.ndarray
    psi: int

    @property
    def roots(self) -> np.ndarray:
        return np.flatnonzero(self.parent < 0)


def grow(x: np.ndarray, picks: list[np.ndarray], psi: int, rng: np.random.Generator) -> Forest:
    """One tree per index array in ``picks``, all trees level by level at once; nodes are numbered by level."""
    n_trees = len(picks)
    rows = np.concatenate(picks)
    node = np.repeat(np.arange(n_trees), [len(p) for p in picks])
    tree, parent = [np.arange(n_trees)], [np.full(n_trees, -1)]
    depth = [np.zeros(n_trees, dtype=int)]
    size = [np.array([len(p) for p in picks])]
    splits = []  # (nodes, feature, threshold, first child) by level
    total, first, owner, width = n_trees, 0, tree[0], x.shape[1]
    flat, differ = np.ascontiguousarray(x).ravel(), _differences(x)
    limit = max(1, math.ceil(math.log2(max(psi, 2))))
    for level in range(limit):
        ids = np.flatnonzero(size[-1])  # nodes with rows
        if not len(ids):
            break
        counts, wish, place = size[-1][ids], rng.random((len(ids), width)), rng.random(len(ids))
        split = np.flatnonzero(counts > 1)
        at = node - first
        shared = np.flatnonzero(size[-1].take(at) > 1)
        rows, at = rows.take(shared), at.take(shared)
        order = np.argsort(at.astype(np.uint16) if total - first <= 1 << 16 else at, kind="stable")  # short numbers are sorted by digits
        rows, counts = rows.take(order), counts[split]
        chosen, lo, hi = _choose(flat, width, rows, counts, wish[split], differ)
        can = hi > lo
        cut = lo + place[split] * (hi - lo)
        cut = np.minimum(cut, np.nextafter(hi, -np.inf))
        if not can.all():
            rows, counts, split, chosen, cut = rows[np.repeat(can, counts)], counts[can], split[can], chosen[can], cut[can]
        goes_right = flat.take(rows * width + np.repeat(chosen, counts)) > np.repeat(cut, counts)
        kid = total + 2 * np.arange(len(split))
        node = np.repeat(kid, counts) + goes_right
        ids = ids[split] + first
        splits.append((ids, chosen, cut, kid))
        kids = np.repeat(ids, 2)
        owner = owner[kids - first]
        tree.append(owner)
        parent.append(kids)
        depth.append(np.full(len(kids), level + 1))
        size.append(np.bincount(node - total, minlength=len(kids)) if len(kids) else np.zeros(0, dtype=int))
        first, total = total, total + len(kids)
    f, t = np.full(total, -1), np.zeros(total)
    lft, rgt = np.full(total, -1), np.full(total, -1)
    for nodes, feature, threshold, kid in splits:
        f[nodes], t[nodes], lft[nodes], rgt[nodes] = feature, threshold, kid, kid + 1
    return Forest(np.concatenate(tree), np.concatenate(parent), f, t, lft, rgt, np.concatenate(size),
                  np.concatenate(depth), psi)


def _differences(x: np.ndarray, most: int = 300) -> np.ndarray | None:
    """For each pair of rows the set of columns in which they differ, as bits; None for many rows, or values that have no order."""
    if len(x) > most or x.shape[1] > 64 or not np.isfinite(x).all():
        return None
    out = np.zeros((len(x), len(x)), np.uint16 if x.shape[1] <= 16 else np.uint64)
    for j in range(x.shape[1]):
        out |= (x[:, None, j] != x[None, :, j]).astype(out.dtype) << out.dtype.type(j)
    return out.ravel()


def _choose(flat: np.ndarray, width: int, rows: np.ndarray, counts: np.ndarray, wish: np.ndarray, differ: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each run of rows its column of the largest ``wish`` whose values differ, and the least and largest value there (equal if there is none)."""
    starts = np.cumsum(counts) - counts
    if not len(counts):
        return np.zeros(0, int), np.zeros(0), np.zeros(0)
    if differ is None:
        values = flat.reshape(-1, width)[rows]
        lo, hi = np.minimum.reduceat(values, starts, axis=0), np.maximum.reduceat(values, starts, axis=0)
        chosen = np.where(hi > lo, wish, -1.0).argmax(axis=1)
        pick = (np.arange(len(chosen)), chosen)
        return chosen, lo[pick], hi[pick]
    # the columns in which a run has more than one value are those in which neighbouring rows differ
    n = len(flat) // width
    of_pair = differ.take(rows * n + np.append(rows[1:], 0))
    of_pair[starts[1:] - 1] = 0
    of_pair[-1] = 0
    bits = np.bitwise_or.reduceat(of_pair, starts)
    apart = bits[:, None] & (bits.dtype.type(1) << np.arange(width, dtype=bits.dtype))
    chosen = np.where(apart != 0, wish, -1.0).argmax(axis=1)
    values = flat.take(rows * width + np.repeat(chosen, counts))
    return chosen, np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)


def path_lengths(forest: Forest, x: np.ndarray, tile: int = 256) -> np.ndarray:
    """Mean path length of every row over all trees."""
    reach = forest.depth + mean_path(forest.size)
    roots, deepest = forest.roots, int(forest.depth.max(initial=0))
    inner, here = forest.feature >= 0, np.arange(len(forest.tree))  # a leaf leads to itself
    column, cut = np.maximum(forest.feature, 0), np.where(inner, forest.threshold, np.inf)
    kids = np.column_stack([np.where(inner, forest.right, here), np.where(inner, forest.left, here)]).ravel()
    out = np.empty(len(x))
    for i in range(0, len(x), tile):
        part = x[i:i + tile]
        at = np.broadcast_to(roots, (len(part), len(roots))).copy()
        flat, first = np.ascontiguousarray(part).ravel(), np.arange(len(part))[:, None] * x.shape[1]
        for _ in range(deepest):
            goes_left = flat.take(column.take(at) + first) <= cut.take(at)
            at = kids.take(2 * at + goes_left)
        out[i:i + tile] = reach[at].mean(axis=1)
    return out


def anomaly_score(forest: Forest, x: np.ndarray) -> np.ndarray:
    """-2^(-E[h] / c(psi)): between -1 and 0, lower is more unusual."""
    c = float(mean_path(np.array([forest.psi]))[0]) or 1.0
    return -np.power(2.0, -path_lengths(forest, x) / c)


@dataclass
class Paths:
    """Per leaf: the box of the distinct features on its path and the share of rows that stays when one is unknown.

    ``slot`` tells for each level of the path which of these features its comparison belongs to, -1 below the leaf."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray
    base: float
    slot: np.ndarray
    forest: Forest


def leaf_paths(forest: Forest) -> Paths:
    deepest = max(1, int(forest.depth.max(initial=0)))
    n = len(forest.tree)
    feat = np.full((n, deepest), -1)
    low, high = np.full((n, deepest), -np.inf), np.full((n, deepest), np.inf)
    share = np.ones((n, deepest))
    for d in range(1, deepest + 1):
        at = np.flatnonzero(forest.depth == d)
        up = forest.parent[at]
        for a in (feat, low, high, share):
            a[at] = a[up]
        feat[at, d - 1] = forest.feature[up]
        is_left = forest.left[up] == at
        high[at[is_left], d - 1] = forest.threshold[up[is_left]]
        low[at[~is_left], d - 1] = forest.threshold[up[~is_left]]
        share[at, d - 1] = forest.size[at] / forest.size[up]
    leaves = np.flatnonzero(forest.feature < 0)
    feat, low, high, share = feat[leaves], low[leaves], high[leaves], share[leaves]
    slot = np.where(feat >= 0, np.arange(deepest), -1)
    for j in range(1, deepest):          # merge repeated features into their first occurrence
        for i in range(j):
            same = (feat[:, j] >= 0) & (feat[:, i] == feat[:, j])
            low[same, i] = np.maximum(low[same, i], low[same, j])
            high[same, i] = np.minimum(high[same, i], high[same, j])
            share[same, i] *= share[same, j]
            slot[same, j] = i
            feat[same, j], low[same, j], high[same, j], share[same, j] = -1, -np.inf, np.inf, 1.0
    value = (forest.depth[leaves] + mean_path(forest.size[leaves])) / max(1, len(forest.roots))
    return Paths(feat, low, high, share, value, float((value * share.prod(axis=1)).sum()), slot, forest)


@lru_cache
def _rule(d: int) -> tuple[np.ndarray, np.ndarray]:
    """Points and weights of the Gauss-Legendre rule on [0, 1] for the polynomials of d features."""
    points, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
    return (points + 1) / 2, weights / 2


def attributions(paths: Paths, x: np.ndarray, n_features: int, cells: int = 4_000_000) -> np.ndarray:
    """Tree-path Shapley values of the mean path length, rows x features.

    A leaf pays feature i the sum over subsets of the other features of
    |S|!(d-1-|S|)!/d! x products; that weight is a Beta integral, so the sum is the
    integral over t of prod_j (share_j (1-t) + inside_j t), a polynomial that a small
    Gauss-Legendre rule integrates exactly.

    What a leaf pays depends only on which comparisons of its path hold. For many rows it is worked out once per
    combination of them and looked up by row; a row with NaN, for which no comparison holds, is worked out by itself.
    """
    if len(x) < TABLE_ROWS or paths.feature.shape[1] > TABLE_DEPTH:
        return _attributions_by_row(paths, x, n_features, cells)
    out = np.zeros((len(x), n_features))
    whole = ~np.isnan(x).any(axis=1)
    out[~whole] = _attributions_by_row(paths, x[~whole], n_features, cells)
    out[whole] = _attributions_by_table(paths, x[whole], n_features)
    return out


def forest_attributions(forest: Forest, x: np.ndarray, n_features: int) -> np.ndarray:
    """``attributions`` of a forest that explains these rows alone: few rows are worked out over its nodes, without a table of leaf paths."""
    if len(x) < TABLE_ROWS and np.isfinite(x).all() and np.isfinite(forest.threshold).all():
        return _attributions_by_node(forest, x, n_features)
    return attributions(leaf_paths(forest), x, n_features)


def _attributions_by_node(forest: Forest, x: np.ndarray, n_features: int, cells: int = 500_000) -> np.ndarray:
    """The sums of ``attributions``, leaf by leaf the same integral, gathered along the tree.

    At a point t of the rule a leaf's product is built up from the root, one factor per feature; the factor of a feature counts once, so a
    repeated one replaces the earlier. What the leaves below an edge pay the feature of that edge has the edge's factor in common, until the
    feature occurs again further down.
    """
    order = np.argsort(forest.depth, kind="stable")  # nodes by level, so that a level is a slice
    place = np.empty(len(order), int)
    place[order] = np.arange(len(order))
    n, n_roots, deepest = len(order), len(forest.roots), int(forest.depth.max(initial=0))
    ends = np.searchsorted(forest.depth[order], np.arange(deepest + 2))
    levels = [slice(*ends[k:k + 2]) for k in range(1, deepest + 1)]
    parent = forest.parent[order]
    of, size = np.maximum(parent, 0), forest.size[order]
    up, feature, cut = place[of], np.where(parent >= 0, forest.feature[of], 0), forest.threshold[of]  # of the comparison that leads to the node
    is_left = forest.left[of] == order
    share = np.where(parent >= 0, size / np.maximum(forest.size[of], 1), 1.0)
    earlier, last = np.full(n, -1), np.full((n, n_features), -1, np.int16 if n < 1 << 15 else np.int32)
    again = []  # by level, nodes with an earlier comparison of their feature; ``earlier`` is the nearest one
    for at in levels:
        above, here = last.take(up[at], axis=0), np.arange(at.start, at.stop)
        column = (here - at.start, feature[at])
        earlier[at] = above[column]
        above[column] = here
        last[at] = above
        again.append(here[earlier[at] >= 0])
        share[again[-1]] *= share[earlier[again[-1]]]
    every = np.concatenate([*again, np.zeros(0, int)])
    value = np.where(forest.feature[order] < 0, (forest.depth[order] + mean_path(size)) / max(1, n_roots), 0.0)[:, None, None]
    points, weights = _rule(max(1, deepest))
    t, w, share = points[:, None], weights[:, None], share[:, None, None]
    pays = np.zeros((n, n_features))
    pays[np.arange(n), feature] = parent >= 0
    out = np.zeros((len(x), n_features))
    step = max(1, cells // (n * len(points)))
    for i in range(0, len(x), step):
        inside = (x[i:i + step].T.take(feature, axis=0) <= cut[:, None]) == is_left[:, None]
        for at in again:
            inside[at] &= inside[earlier[at]]
        inside = inside[:, None, :]
        factor = inside * t  # node x point x row
        factor += share * (1 - t)
        rate = (inside - share) * w
        rate /= factor
        above = rate.take(earlier[every], axis=0)  # beyond this edge the earlier one no longer has the leaves
        rate[every] -= above
        above = factor.take(earlier[every], axis=0)
        factor[every] /= above
        for at in levels[1:]:
            factor[at] *= factor.take(up[at], axis=0)
        factor *= value
        for at in levels[::-1]:
            lefts = np.flatnonzero(is_left[at]) + at.start
            factor[up[lefts]] = factor.take(lefts, axis=0) + factor.take(place[forest.right[order[up[lefts]]]], axis=0)
        out[i:i + step] = np.einsum("ntr,ntr->rn", rate, factor) @ pays
    return out


def _tables(paths: Paths, leaves: np.ndarray, n_features: int) -> np.ndarray:
    """What each leaf pays every feature, for each combination of comparisons on its path: bit k is set if the one of level k holds."""
    d = paths.feature.shape[1]
    holds = (np.arange(1 << d)[:, None] >> np.arange(d)) & 1 > 0
    # slot by slot, leaves x combinations: a feature is inside its box if all its comparisons hold
    inside = [np.ones((len(leaves), 1 << d), bool) for _ in range(d)]
    for level in range(d):
        for j in range(level + 1):
            of_slot = np.flatnonzero(paths.slot[leaves, level] == j)
            inside[j][of_slot] &= holds[:, level]
    share = [paths.share[leaves, j][:, None] for j in range(d)]
    total = [np.zeros((len(leaves), 1 << d)) for _ in range(d)]
    for t, w in zip(*_rule(d)):
        factors = [np.where(inside[j], share[j] * (1 - t) + t, share[j] * (1 - t)) for j in range(d)]
        product = w * factors[0]
        for f in factors[1:]:
            product *= f
        for j in range(d):
            total[j] += product / factors[j]
    out = np.zeros((len(leaves), n_features, 1 << d))
    value = paths.value[leaves][:, None]
    for j in range(d):
        used = np.flatnonzero(paths.feature[leaves, j] >= 0)
        out[used, paths.feature[leaves[used], j]] = (value * (inside[j] - share[j]) * total[j])[used]
    return np.ascontiguousarray(out.transpose(0, 2, 1))


def _attributions_by_table(paths: Paths, x: np.ndarray, n_features: int, tile: int = 2048) -> np.ndarray:
    forest, d = paths.forest, paths.feature.shape[1]
    leaf_nodes = np.flatnonzero(forest.feature < 0)
    number = np.full(len(forest.tree), -1)
    number[leaf_nodes] = np.arange(len(leaf_nodes))
    out = np.zeros((len(x), n_features))
    columns = np.ascontiguousarray(x.T)
    for root in forest.roots:
        nodes = np.flatnonzero(forest.tree == forest.tree[root])
        at = np.full(len(forest.tree), -1)
        at[nodes] = np.arange(len(nodes))
        levels = [nodes[forest.depth[nodes] == k] for k in range(1, d + 1)]
        leaves = nodes[forest.feature[nodes] < 0]
        table = _tables(paths, number[leaves], n_features)
        # of two leaves with one parent exactly one comparison holds, so their tables are added up and read once
        place = {node: i for i, node in enumerate(leaves)}
        reads = []
        for i, node in enumerate(leaves):
            up = forest.parent[node]
            twin = place.get(forest.right[up]) if up >= 0 and forest.left[up] == node else None
            if twin is not None:
                flipped = np.arange(1 << d) ^ (1 << (forest.depth[node] - 1))
                reads.append((at[node], table[i] + table[twin][flipped]))
            elif up < 0 or forest.left[up] == node or forest.left[up] not in place:
                reads.append((at[node], table[i]))
        code = np.empty((len(nodes), min(tile, len(x))), np.uint8)
        paid = np.empty((min(tile, len(x)), n_features))
        for i in range(0, len(x), tile):
            n = min(tile, len(x) - i)
            code[at[root], :n] = (1 << d) - 1
            for k, level in enumerate(levels):
                for node in level:
                    up = forest.parent[node]
                    v, cut = columns[forest.feature[up], i:i + n], forest.threshold[up]
                    fails = v > cut if forest.left[up] == node else v <= cut
                    np.subtract(code[at[up], :n], fails.view(np.uint8) << np.uint8(k), out=code[at[node], :n])
            for row, pays in reads:
                np.take(pays, code[row, :n], axis=0, out=paid[:n], mode="clip")
                out[i:i + n] += paid[:n]
    return out


def _attributions_by_row(paths: Paths, x: np.ndarray, n_features: int, cells: int) -> np.ndarray:
    leaves, d = paths.feature.shape
    points, weights = _rule(d)
    index = np.maximum(paths.feature, 0)
    spread = np.zeros((leaves * d, n_features))
    flat = paths.feature.ravel()
    spread[np.flatnonzero(flat >= 0), flat[flat >= 0]] = 1.0
    out = np.zeros((len(x), n_features))
    step = max(1, cells // (leaves * d))
    for i in range(0, len(x), step):
        v = x[i:i + step][:, index]
        inside = ((v > paths.low) & (v <= paths.high)).astype(float)
        total = np.zeros_like(inside)
        for t, w in zip(points, weights):
            factor = paths.share * (1 - t) + inside * t
            total += w * factor.prod(axis=2, keepdims=True) / factor
        phi = paths.value[None, :, None] * (inside - paths.share) * total
        out[i:i + step] = phi.reshape(len(phi), -1) @ spread
    return out
