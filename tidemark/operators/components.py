"""Small connected components of sets that share values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def small_components(sets: DataFrame, node: str, values: str, most: int) -> DataFrame:
    """(node, component, size) of nodes in components of at most ``most`` nodes; others are left out.

    Two nodes are linked if their arrays ``values`` share an element; elements must be told
    apart by themselves, and ``node`` must be unique. ``component`` is the smallest node.

    Every node takes the smallest label found at any of its values, ``most - 1`` times at
    most: that far reaches across any component of the size asked for. Larger ones need not
    settle; they show by a value at which labels still differ, or by their size. A value that
    very many nodes share is one row per task in the aggregation, and the rows that go back
    to its nodes can be split, since a value has one label.
    """
    state = cut_lineage(sets.select(F.col(node).alias("node"), F.col(values).alias("values"), F.col(node).alias("label")))
    for _ in range(most - 1):
        touched = state.select("node", "label", "values", F.explode("values").alias("value"))
        least = touched.groupBy("value").agg(F.min("label").alias("least"), F.max("label").alias("highest"))
        if least.filter(F.col("least") != F.col("highest")).isEmpty():
            break
        spread = touched.select("node", "values", "value").join(least.select("value", "least"), "value")
        state = cut_lineage(spread.groupBy("node", "values").agg(F.min("least").alias("label")))
    touched = state.select("label", F.explode("values").alias("value"))
    open_ = touched.groupBy("value").agg((F.min("label") != F.max("label")).alias("open")).filter("open")
    unsettled = touched.join(open_, "value", "left_semi").select("label").distinct()
    sizes = state.groupBy("label").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") <= most)
    settled = sizes.join(unsettled, "label", "left_anti")
    return state.join(settled, "label").select(F.col("node").alias(node), F.col("label").alias("component"), "size")
