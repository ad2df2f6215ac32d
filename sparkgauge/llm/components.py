"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgauge.llm.common import discard, packed, store


# Rows of two ids that a partition holds at least, where their number bounds the partitions.
PART_ROWS = 50_000


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable for every node that has a link: node, component.

    links has the columns a and b (any order, repeats allowed). Alternates two rewirings,
    each a minimum per node joined back to the node's links: larger neighbours move to the
    smallest neighbour, then smaller ones do. The links end as stars around the smallest
    node of each component, after a number of rounds that grows with the logarithm of the
    size. Links are such stars when no node with a smaller neighbour has another one. A hub
    with many links is a hot key of a join, which adaptive execution splits; no neighbours
    are collected.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = store(edges, "links")
    n = edges.count()
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n"))
        if least.filter("m < a AND n > 1").isEmpty():
            break
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        )
        large = store(packed(large, n, PART_ROWS), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        last, edges = edges, store(packed(moved, 2 * n, PART_ROWS), "links")
        discard(last, large)
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionByName(ends.select(F.col("component").alias("node"), "component").distinct())
