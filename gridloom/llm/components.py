"""Connected components of an undirected edge table, by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.io import cut_close


def connected(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 40) -> DataFrame:
    """(node, label) for each node of ``edges``: the smallest node it can reach.

    Each round first hangs every larger neighbour on the smallest one (large star), then
    joins a node's smaller neighbours to the smallest of them (small star).  The number
    of rounds follows the logarithm of the longest path, every round is two aggregations
    with partial sums and two equi-joins, and a checkpoint cuts the lineage.
    No edges: no rows.  Raises if ``max_rounds`` do not settle it."""
    e = cut_close(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .where("u <> v").distinct())
    for _ in range(max_rounds):
        both = e.selectExpr("inline(array(struct(u, v), struct(v AS u, u AS v)))")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # the row that holds a node's smallest neighbour hangs the node itself on it
        small = cut_close(large.join(low, "u").select(F.expr("if(v <> m, v, u)").alias("u"), F.col("m").alias("v"))
                          .distinct())
        # settled when no node is both a child and a parent, and each child has one parent
        open_ = (small.selectExpr("inline(array(struct(u AS node, v AS parent), struct(v AS node, null AS parent)))")
                 .groupBy("node").agg(F.min("parent").alias("least"), F.max("parent").alias("most"),
                                      F.max(F.col("parent").isNull()).alias("has_child"))
                 .where("least <> most OR least IS NOT NULL AND has_child"))
        if open_.isEmpty():
            return (small.select(F.col("u").alias("node"), F.col("v").alias("label"))
                    .union(small.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("label"))))
        e = small
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
