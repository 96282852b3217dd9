"""Connected components of an undirected graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawgate.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to its smallest neighbour."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """node, root: for every node of an edge the smallest node it can reach.

    `edges` has columns a and b. Each round is written to the shared folder;
    the number of rounds grows with the logarithm of the longest path. A hot
    node's edges are combined on the map side, and the joins can be split.
    """
    now = staged(edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), f"{label}-edges")
    signature = None
    for round_no in range(max_rounds):
        now = staged(_small_star(_large_star(now)), f"{label}-{round_no}")
        row = now.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("decimal(20,0)")).alias("h")).collect()[0]
        if (row["n"], row["h"]) == signature:
            break
        signature = (row["n"], row["h"])
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).distinct()
