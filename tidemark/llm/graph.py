"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; ``a`` is the larger end."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    below = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return below.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: bigint); component is the smallest node reachable.

    Large and small stars alternate until each component is a star around its
    smallest node. The edge list never grows, a round is written to the shared
    checkpoint folder, and a node's edges meet in joins that Spark can split, not
    in one group. Loops and nulls are ignored; an empty list gives no rows.
    """
    current = cut_lineage(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        # Stars are told by their sums: every round can only lower the ends of edges.
        state = current.agg(
            F.count("a"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            break
        before = state
        current = cut_lineage(_small_star(_large_star(current)).distinct())
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
