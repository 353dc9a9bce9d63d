"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortflow.llm.common import drop_stage, stage


def both_ways(edges: DataFrame) -> DataFrame:
    """Each edge from either end."""
    ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return edges.select(F.explode(ends).alias("e")).select("e.u", "e.v")


def large_star(edges: DataFrame) -> DataFrame:
    """Tie each node's larger neighbours to the smallest node of its neighbourhood."""
    near = both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return near.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Tie each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node of ``edges`` (a, b); other nodes are left out.

    Alternates large and small stars until the edges stand still, which takes about the logarithm
    of the longest path. A node of any degree only meets its neighbourhood's minimum in a join, so hot
    nodes are split like any skewed join. Rounds are written to the shared folder.
    """
    current = stage(edges.where("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        after = stage(small_star(large_star(current)), "edges")
        drop_stage(current)
        current = after
        mark = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if not mark.n or mark == seen:
            break
        seen = mark
    own = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)
