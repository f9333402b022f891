"""Connected components of a table of links, by alternating large and small stars.

Each round is two aggregations and two joins on a node; nothing is gathered in a
task or on the driver, and the number of rows never exceeds that of the links. A
hub with many links is pre-aggregated before its shuffle, and the join that hands
its minimum back has one row per node on the other side, so Spark may split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.tables import written


def component_labels(links: DataFrame, low: str = "a", high: str = "b") -> DataFrame:
    """(node, label) of every node in ``links``; label is the component's smallest node.

    Links may repeat, point either way or join a node to itself; links with a null
    end are left out. No links give no rows. The rounds end when a round changes
    nothing, after about the logarithm of the longest path.
    """
    a, b = F.col(low), F.col(high)
    edges = written(
        links.filter(a.isNotNull() & b.isNotNull())
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    state = _digest(edges)
    while True:
        edges = written(_small_star(_large_star(edges)), "stars")
        now = _digest(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select("v", "v").distinct()
    ).distinct()


def _digest(edges: DataFrame) -> tuple:
    """Count and two order-free sums; equal for equal sets of edges."""
    mask = (1 << 31) - 1
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").bitwiseAND(mask)),
            F.sum(F.xxhash64("v", "u", F.lit(1)).bitwiseAND(mask)),
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.min("v").alias("w"))
    least = least.select("u", F.least("u", "w").alias("w"))
    return (
        edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("w").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("w"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("w"))
    return (
        moved.select(F.col("v").alias("u"), F.col("w").alias("v"))
        .union(least.select("u", F.col("w").alias("v")))
        .distinct()
    )
