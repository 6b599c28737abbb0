"""Connected components by alternating stars: grouped minima and joins, staged every turn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _stars(edges: DataFrame) -> DataFrame:
    """One turn over edges `(a, b)` with `a > b`: neighbours move to their smallest neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    first = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(first, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(first.select("a", F.col("m").alias("b"))).distinct()


def _print(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def components(edges: DataFrame) -> DataFrame:
    """`node, root` for every linked node but the roots; the root is the smallest node.

    `edges` has two columns of one ordered type. Self-links, repeated links and
    either direction are allowed. Turns grow with the logarithm of the longest path.
    """
    a, b = (F.col(c) for c in edges.columns)
    current = staged(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    before, now = None, _print(current)
    while now != before:
        current = staged(_stars(current), "links")
        before, now = now, _print(current)
    return current.toDF("node", "root")
