"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a grouped minimum (combined on the map side) and an equi-join, staged
below the shared folder, so no task holds a component and no label, link or
component passes through the driver.  The number of rounds grows with the logarithm
of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) to (node, root): each node that has an edge to another, and its component's smallest node."""
    links = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(links)
    while state[0]:
        # large star: every larger neighbour of a node is linked to the node's smallest neighbour (or itself)
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: every smaller neighbour, and the node, is linked to the smallest neighbour
        large = staged(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                 .union(least.select("a", F.col("m").alias("b"))).distinct())
        links, before = staged(small, "small-star"), state
        state = _state(links)
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _state(links: DataFrame) -> tuple:
    """Row count and an order-free checksum (one row to the driver)."""
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(mixed), F.sum(F.col("b").cast("decimal(38,0)"))).first())
