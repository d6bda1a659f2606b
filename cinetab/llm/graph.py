"""Connected components of an edge table, as rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; a component is named by its smallest node.

    Each round takes the smallest label of the neighbours, hands it to the node that the old label
    names, and follows labels one step (pointer jumping), so that rounds grow with the logarithm of
    a component's width. Every round is written to the shared folder; nothing is collected.
    An empty edge table gives an empty result.
    """
    both = materialize(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges"
    )
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        offered = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("offer"))
        moved = labels.join(offered, labels.node == offered.a, "left").select(
            "node", "label", F.least("label", "offer").alias("to")
        )
        told = (
            moved.select("node", "to")
            .union(moved.where("to < label").select(F.col("label").alias("node"), "to"))
            .groupBy("node").agg(F.min("to").alias("label"))
        )
        told = materialize(told, "labels")
        up = told.select(F.col("node").alias("label"), F.col("label").alias("above"))
        after = materialize(
            told.join(up, "label", "left").select("node", F.coalesce("above", "label").alias("label")), "labels"
        )
        changed = after.join(labels.withColumnRenamed("label", "was"), "node").where("label <> was").limit(1).count()
        labels = after
        if not changed:
            return labels.select("node", F.col("label").alias("component"))
