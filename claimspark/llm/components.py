"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.common import keep


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _settled(edges: DataFrame) -> bool:
    """Whether distinct edges (u, v), u above v, are stars: no u has two v's, and none is itself a v."""
    above = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    below = edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    ends = above.unionAll(below).groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return ends.where("out > 1 or (out > 0 and into > 0)").isEmpty()


def _star(out: DataFrame) -> DataFrame:
    """Edges (u, v) with u above v: every u moves to the least of its v's and u itself."""
    # the least neighbour is kept as a table: its join then has an exchange on either side,
    # so adaptive execution can split a node with very many edges
    least = keep(out.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return out.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected edges (u, v); root is the least node reachable.

    Each step is written to the shared folder. Repeated edges are allowed; self-edges and edges
    with a null end are left out. Nodes may be of any orderable type. No edges: no rows.
    """
    edges = keep(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _settled(edges):
        large = _star(_both_ways(edges)).where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = keep(large.distinct())
        small = _star(large)
        small = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            small.select("u", F.col("m").alias("v"))
        )
        edges = keep(small.distinct())
    # now every edge leads from a node to its root
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()
