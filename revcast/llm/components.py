"""Connected components of links, by alternating star operations.

Large star hangs every greater neighbour of a node, small star every smaller
one, on the node's least neighbour; repeated in turn, each component becomes a
star around its least node. Both are a grouped minimum (combined before the
shuffle) and a join; each round is written to the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROUNDS = 60
ROWS_PER_PARTITION = 100_000


def settled(df: DataFrame) -> DataFrame:
    """The frame written to the checkpoint folder, in as many partitions as
    its rows need: small frames of many shuffle partitions would make each
    later exchange write a file for each pair of partitions."""
    df = df.checkpoint()
    return df.coalesce(max(1, -(-df.count() // ROWS_PER_PARTITION)))


def star_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node that it reaches) of all
    nodes but the least ones, from links ``a``, ``b`` in any order."""
    edges = settled(links.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    # Joins of a small frame leave it in many partitions, each of which would
    # write files for the next exchange; in one partition it needs none.
    parts = edges.rdd.getNumPartitions() * 2 - 1
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(parts)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(parts)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settled(small.unionByName(least.select("u", F.col("m").alias("v"))).coalesce(parts).distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
    raise RuntimeError("components did not settle")
