"""Text vectors: embedding, projection, density clusters, cluster profile."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.operators.tokens import split_repeated, tokens, word_rows
from tarn.session import cut_lineage

WIDTH = 384
BATCH = 64


def embed(df: DataFrame, encoder: Callable[[Sequence[str]], np.ndarray], id_col: str = "email_id", text: str = "body",
          batch: int = BATCH) -> DataFrame:
    """(id, embedding) from any text encoder, called with batches of texts inside the tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i:i + batch]
                vectors = np.asarray(encoder(part[text].fillna("").tolist()), dtype=np.float32)
                yield pd.DataFrame({id_col: part[id_col].to_numpy(), "embedding": list(vectors)})

    return df.select(id_col, text).mapInPandas(run, f"{id_col} {dict(df.dtypes)[id_col]}, embedding array<float>")


def embed_hashed(df: DataFrame, id_col: str = "email_id", text: str = "body", width: int = WIDTH) -> DataFrame:
    """Built-in encoder without a model file: words hashed with a sign into ``width`` sums, unit length.

    Texts whose id occurs once are summed inside their rows; rows that share an id get the vector of all its texts, rows without an id zeros.
    """
    once, again = split_repeated(df.select(id_col, text), id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                marks = batch.column(1)
                doc = np.repeat(np.arange(len(marks)), marks.value_lengths().to_numpy())
                mark = marks.flatten().to_numpy()  # slot + 1, negative for words that are subtracted
                sums = np.bincount(doc * width + np.abs(mark) - 1, weights=np.sign(mark), minlength=len(marks) * width).reshape(-1, width)
                norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
                unit = np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 0).astype(np.float32)
                ends = pa.array(np.arange(len(marks) + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(unit.ravel()))], names=[id_col, "embedding"])

    marks = F.transform("words", lambda w: F.when(_sign(w) > 0, _slot(w, width) + 1).otherwise(-1 - _slot(w, width)))
    listed = word_rows(once, id_col, text).select(id_col, marks.alias("marks"))
    out = listed.mapInArrow(run, f"{id_col} {dict(df.dtypes)[id_col]}, embedding array<float>")
    return out if again is None else out.unionByName(_embed_by_id(again, id_col, text, width))


def _slot(word: Column, width: int) -> Column:
    return F.pmod(F.xxhash64(word, F.lit("slot")), F.lit(width)).cast("int")


def _sign(word: Column) -> Column:
    return F.when(F.pmod(F.xxhash64(word, F.lit("sign")), F.lit(2)) == 0, 1.0).otherwise(-1.0)


def _embed_by_id(df: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """The vectors of ``embed_hashed`` from one long table of words, grouped by id."""
    word = F.col("term")
    sums = tokens(df, id_col, text, 1).groupBy(id_col, _slot(word, width).alias("slot")).agg(F.sum(_sign(word)).alias("v"))
    # lengths are taken on the long rows: inside a list expression they would be recomputed per element
    norm = F.sqrt(F.sum(F.col("v") * F.col("v")).over(Window.partitionBy(id_col)))
    unit = sums.withColumn("u", F.when(norm > 0, F.col("v") / norm).otherwise(F.lit(0.0)))
    packed = unit.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("slot", "u"))).alias("m"))
    every = df.select(id_col).join(packed, id_col, "left").withColumn(
        "m", F.coalesce("m", F.create_map().cast("map<int,double>")))
    dense = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0.0)))
    return every.select(id_col, dense.cast("array<float>").alias("embedding"))


def project(df: DataFrame, id_col: str, vec: str, k: int = 2) -> DataFrame:
    """(id, x, y, ...) on the first principal components."""
    vectors = df.select(id_col, array_to_vector(F.col(vec).cast("array<double>")).alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="p").fit(vectors)
    out = model.transform(vectors).withColumn("p", vector_to_array("p"))
    names = ["x", "y", "z"] if k <= 3 else [f"p{i}" for i in range(k)]
    return out.select(id_col, *[F.col("p")[i].alias(names[i]) for i in range(k)])




def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node id; alternating large and small stars.

    The number of rounds grows with the logarithm of the graph, not with its diameter;
    every round is checkpointed so that lineage stays short and executors can be lost.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = cut_lineage(e)
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u")
        nxt = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        nxt = cut_lineage(nxt.filter("u <> v").distinct())
        changed = nxt.exceptAll(e).limit(1).count() + e.exceptAll(nxt).limit(1).count()
        e = nxt
        if not changed:
            break
    return nodes.join(e.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def _near_cells() -> Column:
    """The cells that can hold points within eps of a cell of side eps / sqrt(2), the cell itself included."""
    steps = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if abs(i) + abs(j) < 4]
    return F.array(*[F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j")) for i, j in steps])


def _linked_cells(core: DataFrame, eps: float, side: float, split: int = 8) -> DataFrame:
    """(a, b): neighbouring cells with two core points within eps, found by refining boxes.

    Core points of a cell are summed up as tight boxes. A pair of boxes whose farthest
    corners are within eps links the cells, one whose nearest corners are not is out;
    only undecided boxes are split further, until they are single points.
    """
    corners = [F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")]
    links, width, todo = None, side, None
    pts = core
    level = 0
    while True:
        width = width / split
        level += 1
        pts = cut_lineage(pts.withColumns({"_bx": F.floor(F.col("x") / width), "_by": F.floor(F.col("y") / width)}))
        keys = ["cell", "cx", "cy", "_bx", "_by"] + (["_box"] if todo is not None else [])
        boxes = pts.groupBy(*keys).agg(*corners)
        if todo is None:
            left = boxes.withColumn("_s", F.explode(_near_cells())).withColumns(
                {"ax": F.col("cx") + F.col("_s.i"), "ay": F.col("cy") + F.col("_s.j")}).drop("_s")
            pair_on = ["ax", "ay"]
            right = boxes.select(F.col("cx").alias("ax"), F.col("cy").alias("ay"), *_renamed(boxes))
            pairs = left.join(right, pair_on).filter("cell < r_cell")
        else:
            l2 = boxes.join(todo.select(F.col("l_box").alias("_box"), "r_box").distinct(), "_box")
            right = boxes.select(F.col("_box").alias("r_box"), *_renamed(boxes))
            pairs = l2.join(right, "r_box")
        gap_x = F.greatest(F.lit(0.0), F.col("x0") - F.col("r_x1"), F.col("r_x0") - F.col("x1"))
        gap_y = F.greatest(F.lit(0.0), F.col("y0") - F.col("r_y1"), F.col("r_y0") - F.col("y1"))
        far_x = F.greatest(F.abs(F.col("x1") - F.col("r_x0")), F.abs(F.col("r_x1") - F.col("x0")))
        far_y = F.greatest(F.abs(F.col("y1") - F.col("r_y0")), F.abs(F.col("r_y1") - F.col("y0")))
        judged = pairs.select(
            F.col("cell").alias("a"), F.col("r_cell").alias("b"),
            F.concat_ws("_", F.lit(level), "cell", "_bx", "_by").alias("l_box"),
            F.concat_ws("_", F.lit(level), "r_cell", "r__bx", "r__by").alias("r_box"),
            (F.hypot(far_x, far_y) <= eps).alias("sure"), (F.hypot(gap_x, gap_y) <= eps).alias("open")).filter("open")
        judged = cut_lineage(judged)
        sure = judged.filter("sure").select("a", "b").distinct()
        links = sure if links is None else links.union(sure)
        todo = judged.join(sure, ["a", "b"], "left_anti")
        if todo.limit(1).count() == 0:
            return links.distinct()
        todo = cut_lineage(todo)
        wanted = todo.select(F.col("l_box").alias("_box")).union(todo.select(F.col("r_box").alias("_box"))).distinct()
        pts = pts.withColumn("_box", F.concat_ws("_", F.lit(level), "cell", "_bx", "_by")).drop("_bx", "_by").join(wanted, "_box")


def _renamed(boxes: DataFrame) -> list[Column]:
    return [F.col(c).alias(f"r_{c}") for c in ("cell", "_bx", "_by", "x0", "x1", "y0", "y1")]


def density_cluster(df: DataFrame, eps: float, min_samples: int = 15, min_size: int = 80, id_col: str = "email_id",
                    lanes: int = 8) -> DataFrame:
    """(id, embedding_cluster, cluster_probability) of planar points x, y.

    A core point has ``min_samples`` points within ``eps`` (itself included); core
    points within eps of each other share a cluster; other points join the nearest
    core point in reach; clusters below ``min_size`` and the rest are noise, -1. The
    cluster is named by its smallest cell label. Strength is 1 - distance / eps to the
    nearest core point.

    The plane is cut into cells whose points are all within eps of each other, so a
    cell with enough points needs no distances at all, and clusters are connected over
    cells. Only points of thin cells are compared with their surroundings.
    """
    side = eps / math.sqrt(2)
    pts = df.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("pid")).withColumns(
        {"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)})
    cells = pts.groupBy("cx", "cy").agg(F.sum("n").alias("in_cell"), F.min("pid").alias("cell"))
    pts = cut_lineage(pts.join(cells, ["cx", "cy"]))
    thin = pts.filter(F.col("in_cell") < min_samples)

    def around(targets: DataFrame) -> DataFrame:
        """Points of thin cells next to every target point in reach (pairs are counted or reduced at once)."""
        sent = thin.select("pid", "x", "y", F.explode(_near_cells()).alias("s"), "cx", "cy").select(
            "pid", "x", "y", (F.col("cx") + F.col("s.i")).alias("tx"), (F.col("cy") + F.col("s.j")).alias("ty"),
            F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
        spread = targets.withColumn("lane", F.pmod(F.xxhash64("x", "y"), F.lit(lanes)).cast("int")).select(
            F.col("cx").alias("tx"), F.col("cy").alias("ty"), "lane", F.col("x").alias("ox"), F.col("y").alias("oy"),
            F.col("n").alias("on"), F.col("pid").alias("opid"), F.col("cell").alias("ocell"))
        near = sent.join(spread, ["tx", "ty", "lane"])
        return near.withColumn("dist", F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy"))).filter(F.col("dist") <= eps)

    crowd = around(pts).groupBy("pid").agg(F.sum("on").alias("crowd"))
    thin_core = thin.join(crowd.filter(F.col("crowd") >= min_samples).select("pid"), "pid", "left_semi")
    core = cut_lineage(pts.filter(F.col("in_cell") >= min_samples).unionByName(thin_core.select(*pts.columns)))
    linked = _linked_cells(core.select("cell", "cx", "cy", "x", "y"), eps, side)
    comps = connected_components(core.select(F.col("cell").alias("node")).distinct(), linked)
    comps = cut_lineage(comps.select(F.col("node").alias("ocell"), F.col("component").alias("cluster")))
    inside = core.join(comps.withColumnRenamed("ocell", "cell"), "cell").select("pid", "cluster", F.lit(0.0).alias("dist"))
    nearest = around(core).groupBy("pid").agg(F.min(F.struct("dist", "opid", "ocell")).alias("m"))
    border = nearest.join(core.select("pid"), "pid", "left_anti").select("pid", "m.dist", F.col("m.ocell").alias("ocell")).join(
        comps, "ocell").select("pid", "cluster", "dist")
    member = inside.unionByName(border)
    sized = member.join(pts.select("pid", "n"), "pid").groupBy("cluster").agg(F.sum("n").alias("size"))
    kept = member.join(sized.filter(F.col("size") >= min_size), "cluster", "left_semi")
    named = pts.select("x", "y", "pid").join(kept, "pid", "left")
    return df.join(named, ["x", "y"], "left").select(
        id_col, F.coalesce(F.col("cluster"), F.lit(-1).cast("long")).alias("embedding_cluster"),
        F.when(F.col("cluster").isNotNull(), 1 - F.col("dist") / eps).otherwise(F.lit(0.0)).alias("cluster_probability"))


def cluster_profile(df: DataFrame, cluster: str = "embedding_cluster") -> DataFrame:
    """Rows and share per cluster."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("share", F.col("n_rows") / total)
