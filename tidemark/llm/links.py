"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import staged


def components(links: DataFrame, one: str = "a", other: str = "b") -> DataFrame:
    """``node, label``: for every node of a link, the smallest node it can reach.

    Each round a node takes the smallest label around it, then the label of that label, so paths shorten
    by half. Rounds are staged: no lineage grows, and a lost executor costs one round. Minima are taken in
    each task first; a node with very many links is split by the adaptive join.
    """
    both = links.select(F.col(one).alias("node"), F.col(other).alias("next"))
    both = staged(both.union(both.select("next", "node")).where("node <> next").distinct(), "links")
    labels = staged(both.groupBy("node").agg(F.least("node", F.min("next")).alias("label")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("next"), F.col("label").alias("near")), "next")
        least = around.groupBy("node").agg(F.min("near").alias("near"))
        taken = labels.join(least, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        after = taken.join(jump, "new").select("node", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("moved"))
        after = staged(after, "labels")
        labels = after.select("node", "label")
        if after.where("moved").isEmpty():
            return labels
