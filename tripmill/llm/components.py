"""Connected components of a graph given by edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored


def _lowest(edges: DataFrame) -> DataFrame:
    """(node, other, low): every directed edge with the lowest end in the node's neighbourhood.

    The lowest ends are stored first, so the join has two plain exchanges and adaptive execution
    can split the rows of a node with very many edges.
    """
    low = edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("low"))
    return edges.join(stored(low, "components-low"), "node")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the lowest end around that node."""
    both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    linked = _lowest(both).filter(F.col("other") > F.col("node"))
    linked = linked.select(F.col("other").alias("node"), F.col("low").alias("other"))
    return stored(linked.distinct(), "components-large")


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the lowest of them."""
    linked = _lowest(edges).select(
        F.explode(F.array("node", "other")).alias("node"), F.col("low").alias("other")
    )
    linked = linked.filter(F.col("node") > F.col("other"))
    return stored(linked.distinct(), "components-small")


def _digest(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("node", "other")
    return tuple(edges.agg(F.count("*"), F.sum(mixed.cast("decimal(38,0)")), F.bit_xor(mixed)).first())


def lowest_reachable(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): for each node with an edge, the lowest node it reaches, itself included.

    Alternates large-star and small-star steps until the edges no longer change, which takes
    about as many rounds as the logarithm of the longest path. Every step reads stored edges and
    stores its own, so a lost executor repeats one step. Loops and repeated edges are ignored;
    edges with a null end are, too. The driver sees two counts per round.
    """
    ends = edges.filter(F.col(a) != F.col(b))
    ends = ends.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other"))
    edges, seen = stored(ends.distinct(), "components-edges"), None
    while (now := _digest(edges)) != seen:
        seen = now
        if now[0] == 0:
            break
        edges = _small_star(_large_star(edges))
    roots = edges.select("node", F.col("other").alias("root"))
    tops = edges.select(F.col("other").alias("node"), F.col("other").alias("root")).distinct()
    return roots.unionByName(tops)
