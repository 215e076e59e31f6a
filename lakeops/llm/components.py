"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import discard, settle


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``component`` (the smallest node that can be reached) for every node with an edge.

    Each round points every node at its smallest neighbour, follows the pointers to the end by
    doubling, and contracts the edges to the ends; at most half of the nodes are left after it, so
    the number of rounds grows with the logarithm of the nodes. All of it is joins and minima, which
    combine before they shuffle; a hub with many neighbours is a skewed side of a join that the
    adaptive planner splits. Every round is written to the shared folder, which cuts the lineage; what the next one has
    replaced is removed.
    Loops and repeated edges do no harm; rows with a null end are no edges.
    """
    both = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null")
    links = settle(both.union(both.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels, replaced = links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct(), []
    while links.head(1):
        pointers = settle(
            links.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("to")), "pointers")
        while True:
            ends = pointers.select(F.col("node").alias("to"), F.col("to").alias("further"))
            jumped = settle(
                pointers.join(ends, "to").select("node", F.col("further").alias("to"),
                                                 (F.col("further") != F.col("to")).alias("moved")), "pointers")
            discard(pointers)
            pointers = jumped.drop("moved")
            if not jumped.where("moved").head(1):
                break
        named = settle(
            labels.join(pointers.select(F.col("node").alias("component"), "to"), "component", "left")
                  .select("node", F.coalesce("to", "component").alias("component")), "labels")
        to_left = pointers.select(F.col("node").alias("a"), F.col("to").alias("a_to"))
        to_right = pointers.select(F.col("node").alias("b"), F.col("to").alias("b_to"))
        contracted = settle(
            links.join(to_left, "a").join(to_right, "b").where("a_to != b_to")
                 .select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).distinct(), "links")
        discard(links, pointers, *replaced)
        labels, links, replaced = named, contracted, [named]
    return labels
