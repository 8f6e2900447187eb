"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
    return tuple(row)


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        .filter("hi <> lo").distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).filter("hi <> lo")
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``links`` ``(a, b)``, the root being the least node reachable.

    Nodes without a link to another node are left out. The neighbours of a node are never gathered:
    each round takes minima with map-side combination and joins them back. The number of rounds
    grows with the logarithm of the longest path; each round's links go to the shared folder.
    """
    edges = cut(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct()
    )
    state = _state(edges)
    while state[0]:
        edges = cut(_small(_large(edges)))
        after = _state(edges)
        if after == state:
            break
        state = after
    roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
