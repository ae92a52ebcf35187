"""Connected components of a link table by repeated least labels; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import cut


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, b): the least node that it can reach.

    Each round takes the least label around a node, then the label of that label, so long chains shorten by more than half.
    """
    edges = cut(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = cut(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        around = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        closer = labels.join(around, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = cut(closer.join(jump, "next", "left").select("node", "label", F.least("next", F.coalesce("far", "next")).alias("next")))
        changed = moved.where("next < label").limit(1).count()
        labels = moved.select("node", F.col("next").alias("label"))
        if not changed:
            return labels
