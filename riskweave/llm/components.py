"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.scratch import Scratch


def _steps(parents: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Follow parents to their ends, doubling the step until nothing changes."""
    turn = 0
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        longer = parents.join(up, "parent", "left").select(
            "node",
            F.coalesce("above", "parent").alias("parent"),
            F.col("above").isNotNull().alias("moved"),
        )
        turn += 1
        written = scratch.keep(longer, f"{name}-{turn}")
        moved = written.where("moved").limit(1).count()
        parents = written.select("node", "parent")
        if not moved:
            return parents


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label) of every node with a link; the label is the component's smallest node.

    ``links`` has long columns ``a`` and ``b``.  Every node is merged into its smallest
    neighbour, chains of merges are followed to their ends, links are renamed and links within
    a node dropped, until none is left.  Neighbours are reduced by a minimum with partial
    aggregation, and renaming joins two written tables, so a node with very many links is
    neither gathered nor kept in one task.
    """
    labels, turn = None, 0
    while True:
        turn += 1
        step = f"{name}-turn-{turn}"
        both = links.select("a", "b").unionByName(links.selectExpr("b as a", "a as b"))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        own = scratch.keep(parents.where("parent < node"), f"{step}-parents")
        ends = _steps(own, scratch, f"{step}-ends")
        if labels is None:
            nodes = both.select(F.col("a").alias("node")).distinct()
            labels = nodes.join(ends, "node", "left").select(
                "node", F.coalesce("parent", "node").alias("label")
            )
        else:
            labels = labels.join(ends.withColumnRenamed("node", "label"), "label", "left").select(
                "node", F.coalesce("parent", "label").alias("label")
            )
        labels = scratch.keep(labels, f"{step}-labels")
        for side in ("a", "b"):
            links = links.join(ends.withColumnRenamed("node", side), side, "left").withColumn(
                side, F.coalesce("parent", side)
            ).drop("parent")
        links = scratch.keep(links.where("a <> b").select("a", "b").distinct(), f"{step}-links")
        if not links.limit(1).count():
            return labels
