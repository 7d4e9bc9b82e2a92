"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import cut


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "low"))).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points at the smallest one."""
    both = links.union(links.select(F.col("low"), F.col("node")))
    least = both.groupBy("node").agg(F.min(F.least("node", "low")).alias("least"))
    return (
        both.join(least, "node")
        .where("low > node")
        .select(F.col("low").alias("node"), F.col("least").alias("low"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point at the smallest of them."""
    least = links.groupBy("node").agg(F.min("low").alias("least"))
    moved = links.join(least, "node").where("low > least").select("low", "least")
    return least.union(moved).toDF("node", "low").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge; the root is the smallest node of its component.

    `edges` has two long columns. Alternating large and small stars shrink every component to a
    star in a few rounds; each round is written to the shared folder, and only a row count and a
    checksum come to the driver. Hubs are joined with one row each, which the adaptive planner
    splits. Loops and repeated edges are allowed, rows with a null end are ignored.
    """
    a, b = (F.col(c) for c in edges.columns)
    links = edges.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("low"))
    links = cut(links.where(a.isNotNull() & b.isNotNull() & (a != b)).distinct(), "links")
    before, now = None, _state(links)
    while now != before:
        links = cut(_small_star(_large_star(links)), "links")
        before, now = now, _state(links)
    roots = links.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return links.select("node", F.col("low").alias("root")).union(roots)
