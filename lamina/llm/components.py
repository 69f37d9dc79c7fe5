"""Connected components of a large graph by alternating large-star and small-star steps.

Every step is an aggregate and a join of edge lists; no task and not the driver ever holds a whole
component. The edges are stored after every round, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lamina.llm.common import stash_seen
from lamina.operators.joins import lookup_join


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect the larger neighbours of each node to the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = lookup_join(both, least, "u", "inner").filter(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect each node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = lookup_join(edges, least, "u", "inner")
    moved = joined.filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v); the root is the least node.

    Loops and repeated edges are ignored; nodes without an edge to another do not appear. No edges give no
    rows. Keys may be of any type that can be ordered.
    """
    wanted = {"n": F.count(F.lit(1)), "x": F.bit_xor(F.xxhash64("u", "v"))}

    def clean(df: DataFrame) -> DataFrame:
        ordered = df.filter(F.col("u") != F.col("v")).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        )
        return ordered.distinct()

    edges, seen = stash_seen(clean(edges), "edges", **wanted)
    while seen["n"]:
        before = seen
        edges, seen = stash_seen(clean(_small_star(clean(_large_star(edges)))), "edges", **wanted)
        if seen == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
