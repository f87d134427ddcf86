"""Connected components of a graph given as links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.session import checkpointed


def _smaller_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its smaller neighbours and itself under the smallest of them."""
    low = edges.groupBy("hi").agg(F.min("lo").alias("root"))
    return (edges.join(low, "hi").select(F.col("root").alias("lo"), F.col("lo").alias("hi")).filter("lo < hi")
            .unionByName(low.select(F.col("root").alias("lo"), "hi")).distinct())


def _larger_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours under the smallest node it knows."""
    low = edges.groupBy("hi").agg(F.min("lo").alias("root"))
    return (edges.join(low.withColumnRenamed("hi", "lo"), "lo", "left")
            .select(F.coalesce("root", "lo").alias("lo"), "hi").distinct())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """One row (node, root) for every node that has a link: ``root`` is the smallest node it can reach.

    ``links`` is a DataFrame of two long columns; direction, repeats, nulls and
    self links do not matter.  A node's neighbours are never gathered: each
    round takes a minimum (combined before the shuffle) and joins it back, so a
    hot node is a skewed join, which AQE splits.  Every round is checkpointed.
    """
    edges = checkpointed(links.filter(F.col(a) != F.col(b))
                         .select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct())
    known = None
    while True:
        edges = checkpointed(_larger_star(_smaller_star(edges)))
        # Stars and nothing else: each node is under one root, and no root is under another.
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if state == known:
            break
        known = state
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
