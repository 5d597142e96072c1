"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node that has a link (a, b).

    Rounds of taking the smallest label next door and then the label of that label. Hubs are harmless: neighbours are
    reduced by partial aggregation, and joins on a hub are between stored tables, which adaptive execution can split.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = stored(labels.join(near, labels["node"] == near["a"])
                      .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "labels")
        up = step.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        jumped = stored(step.join(up, "label").select("node", F.col("higher").alias("label"),
                                                      (F.col("higher") != F.col("old")).alias("moved")), "labels")
        labels = jumped.select("node", "label")
        if jumped.filter("moved").isEmpty():
            return labels
