"""Connected components of a graph held in Spark, by alternating large-star and small-star.

Each round re-hangs every edge on the smallest neighbour of one of its ends, which
keeps components and shortens paths; rounds go on until no edge changes.  A star's
neighbours are never gathered: a round takes one minimum for each node, pre-aggregated
before its exchange, and one equi-join, whose hot keys Spark splits.  Only counts and
checksums come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, unstage


def _large(edges: DataFrame) -> DataFrame:
    """Larger neighbours go to the smallest neighbour of a node, or to itself."""
    both = edges.select(F.col("u").alias("n"), F.col("v").alias("x")).union(edges.select(F.col("v").alias("n"), F.col("u").alias("x")))
    least = stage(both.groupBy("n").agg(F.min("x").alias("low")).select("n", F.least("n", "low").alias("low")), "star")
    moved = both.filter("x > n").join(least, "n").select(F.col("x").alias("u"), F.col("low").alias("v"))
    return moved.distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    least = stage(edges.groupBy("u").agg(F.min("v").alias("low")), "star")
    met = edges.join(least, "u")
    moved = met.filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")).union(least.select("u", F.col("low").alias("v")))
    return moved.distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v) of any order and with repeats -> (node, root), root the smallest node that it reaches.

    Nodes without an edge to another node are not returned."""
    now = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        last, old = mark, now
        now = stage(_small(_large(now)), "edges")
        mark = _mark(now)
        unstage(old)
        if mark == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct())
