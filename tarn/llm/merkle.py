"""Merkle manifest of a table by checkpoint and recompute.

Rows are leaves of one tree per value of a column (for documents the language); the roots of these trees are the leaves of the
root tree. Every ``FAN`` consecutive nodes become the digest of their concatenated digests while more than one is left.

Only every ``STRIDE``-th level is stored. A stored level falls into aligned subtrees of ``FAN ** STRIDE`` nodes; a proof
regenerates the missing interior nodes of each such subtree from its stored descendants, emits the siblings, and drops the
nodes again. Siblings above a subtree are the same for all its leaves and are worked out once, from the root downwards.

Rows are numbered by a range partitioning and per-partition offsets, so no tree is ever one task, whatever its share of rows.
Every subtree is a bounded group. Digests of nodes are lowercase hex SHA-256 of hex text.

Rows: repeated rows are leaves of their own (equal digests, neighbouring positions); a null key sorts first; a null tree value is a
tree of its own, before all others; null fields are ``-``; empty texts are ``0:``. An empty table has no root and no proofs.
Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import stored

FAN = 8
STRIDE = 3
SUBTREE = FAN ** STRIDE
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def row_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each value as its length in UTF-8 bytes, a colon and its text, or ``-`` if null."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to along ``path``: a proof holds if this is the stored root."""
    return F.aggregate(path, leaf, lambda node, level: digest(level["before"], node, level["after"]))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, from left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda s: F.array(s["before"], s["after"]))), ""), 256)


def numbered(df: DataFrame, tree: str, order: Sequence[str], name: str) -> DataFrame:
    """Adds ``pos`` (from 0 within the tree, by ``order``) and ``total``. Rows are sorted over partitions; one row per partition and
    tree is enough to know how many rows come before."""
    rows = stored(df.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order).withColumn("at", F.monotonically_increasing_id())
                  .withColumn("part", F.shiftright("at", 33)), name)
    runs = rows.groupBy(tree, "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    all_rows = Window.partitionBy(tree)
    before = F.coalesce(F.sum("n").over(all_rows.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(tree, "part", (before - F.col("first")).alias("shift"), F.sum("n").over(all_rows).alias("total"))
    return rows.join(runs, [tree, "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _subtrees(nodes: DataFrame, *carried: str) -> DataFrame:
    """One row per aligned subtree of a stored level: its nodes in order and the regenerated levels ``l0`` to ``l3``.

    A tree that fits in one subtree ends as soon as one node is left; in a larger one each level is hashed, also a run of one.
    """
    out = (nodes.groupBy("tree", F.floor(F.col("pos") / SUBTREE).alias("up")).agg(
        F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("pos", "digest", *carried))).alias("nodes"))
        .withColumn("l0", F.transform("nodes", lambda x: x["digest"])))
    for k in range(STRIDE):
        below = F.col(f"l{k}")
        runs = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / FAN).cast("int"))
        hashed = F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(below, i * FAN + 1, F.lit(FAN)), ""), 256))
        out = out.withColumn(f"l{k + 1}", F.when((F.col("total") > SUBTREE) | (F.size(below) > 1), hashed).otherwise(below))
    return out


def _level_above(nodes: DataFrame) -> DataFrame:
    return _subtrees(nodes).select("tree", F.col("up").alias("pos"), F.ceil(F.col("total") / SUBTREE).alias("total"),
                                   F.element_at(f"l{STRIDE}", 1).alias("digest"))


def _paths(nodes: DataFrame, above: DataFrame, *carried: str) -> DataFrame:
    """(tree, pos, digest, carried, subroot, path) of each node, given subroot and path of its subtree's top in ``above``."""
    def local(x: Column) -> Column:
        levels = []
        for k in range(STRIDE):
            level = F.col(f"l{k}")
            at = F.floor(F.pmod(x["pos"], F.lit(SUBTREE)) / FAN ** k).cast("int")
            place = F.pmod(at, F.lit(FAN))
            sides = F.struct(F.array_join(F.slice(level, at - place + 1, place), "").alias("before"),
                             F.array_join(F.slice(level, at + 2, F.lit(FAN - 1) - place), "").alias("after"))
            levels.append(F.when((F.col("total") > SUBTREE) | (F.size(level) > 1), sides))
        return F.concat(F.array_compact(F.array(*levels)), F.col("path"))

    groups = _subtrees(nodes, *carried).join(above.select("tree", F.col("pos").alias("up"), "subroot", "path"), ["tree", "up"])
    rows = F.transform("nodes", lambda x: F.struct(x["pos"].alias("pos"), x["digest"].alias("digest"), *[x[c].alias(c) for c in carried], local(x).alias("path")))
    return groups.select("tree", "subroot", F.inline(rows))


@dataclass
class Tree:
    """Stored levels of trees, from the leaves upwards; the last holds one node per tree."""

    levels: list[DataFrame]

    @classmethod
    def build(cls, leaves: DataFrame, name: str) -> Tree:
        """``leaves`` has tree, pos, total, digest and is stored; the levels above are stored here."""
        levels = [leaves]
        most = leaves.agg(F.max("total")).first()[0] or 1
        while most > 1:
            levels.append(stored(_level_above(levels[-1]), f"{name}-{len(levels)}"))
            most = -(-most // SUBTREE)
        return cls(levels)

    def paths(self, tops: DataFrame, *carried: str) -> DataFrame:
        """Paths of all leaves; ``tops`` has the path from each tree's root on (tree, pos = 0, subroot, path)."""
        above = tops
        for level in reversed(self.levels[1:]):
            above = _paths(level, above)
        return _paths(self.levels[0], above, *carried)


@dataclass
class Manifest:
    """Stored levels of the trees and of the root tree over their roots."""

    trees: Tree
    roots: Tree
    root: str | None
    carried: tuple[str, ...]

    def proofs(self) -> DataFrame:
        """(tree, pos, key, carried, leaf, subroot, root, path), one row per leaf.

        ``path`` holds for each hashed level the siblings before and after the node. A filter on tree, pos or key reads all stored
        leaves but regenerates only what it needs.
        """
        start = self.roots.levels[-1].select("tree", "pos", F.lit(None).cast("string").alias("subroot"), F.array().cast(PATH).alias("path"))
        tops = self.roots.paths(start, "of").select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "path")
        return self.trees.paths(tops, "key", *self.carried).withColumnRenamed("digest", "leaf").withColumn("root", F.lit(self.root).cast("string"))


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, tree: str = "lang", key: str = "doc_id", carry: dict[str, Column] | None = None) -> Manifest:
    """Stores leaves and every ``STRIDE``-th level above. Leaves of a tree ascend by ``key``, equal keys by digest.

    ``carry`` names further values to keep with a leaf, such as the digest that another version of the row has.
    """
    carry = carry or {}
    rows = stored(docs.select(F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("")).alias("tree"), F.col(key).alias("key"),
                              row_digest([F.col(f) for f in fields]).alias("digest"), *[c.alias(n) for n, c in carry.items()]), "rows")
    trees = Tree.build(stored(numbered(rows, "tree", ["key", "digest"], "leaves"), "level-0"), "level")
    tops = trees.levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    roots = Tree.build(stored(numbered(tops, "tree", ["of"], "tops"), "roots-0"), "roots")
    root = roots.levels[-1].first()
    return Manifest(trees, roots, root["digest"] if root else None, tuple(carry))
