"""Connected components of a table of links, by stars that shrink round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.plans.durable import durable


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _round(edges: DataFrame) -> DataFrame:
    """One large star, then one small star; edges are pairs a > b without repetition."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    large = near.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = durable(large.filter("a != b").distinct())
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    joined = large.join(least, "a")
    small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return durable(small.filter("a != b").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of links (a, b): root is the smallest node that it reaches.

    The smallest neighbours come from partial aggregations, and a node with very many links meets
    them in a join that adaptive execution can split.  The driver sees two numbers a round: the
    count and a checksum of the links, which stay the same once all links lead to a root.
    """
    edges = durable(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before, edges = state, _round(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
