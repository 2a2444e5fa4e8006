"""Connected components of a link table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stmtscope.llm.scratch import Scratch


def smallest_reachable(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each end of ``links`` (low, high) reaches.

    Each round hooks every node to its smallest neighbour, follows those parents to their
    roots by doubling, and goes on with the links between different roots.  Node counts
    at least halve per round; a hot node only meets pre-aggregated minima.
    """
    edges = links.where("low < high").select("low", "high")
    ends = edges.select(F.explode(F.array("low", "high")).alias("node")).distinct()
    roots = ends.select("node", F.col("node").alias("component"))
    while True:
        parents = scratch.keep(edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("parent")))
        while True:  # parents are smaller than their nodes, so this ends
            above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            moved, n_moved = scratch.keep_and_count(
                parents.join(above, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"), "above"),
                F.col("above").isNotNull(),
            )
            parents = moved.select("node", "parent")
            if not n_moved:
                break

        up = parents.withColumnRenamed("node", "component")
        roots = scratch.keep(
            roots.join(up, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
        )

        for end in ("low", "high"):
            up = parents.select(F.col("node").alias(end), F.col("parent").alias("to"))
            edges = edges.join(up, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        edges, n_edges = scratch.keep_and_count(
            edges.where("low <> high")
            .select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high"))
            .distinct(),
            F.lit(True),
        )
        if not n_edges:
            return roots
