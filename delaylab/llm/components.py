"""Connected components of a large edge table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylab.llm.scratch import stored as materialize


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 1_000_033)
    ).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for the ends of ``edges`` (u, v: longs): the smallest node reachable.

    Both kinds of round replace edges by edges to a smaller neighbour; the smallest of a
    neighbourhood is a partial aggregate, so a node with very many edges is reduced before it
    travels, and the join that follows may split it. Loops, repeated edges and no edges at all
    are allowed.
    """
    now = materialize(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    mark = None
    while True:
        seen = _fingerprint(now)
        if seen == mark or seen[0] == 0:
            break
        mark = seen
        # Large star: every larger neighbour of a node turns to the smallest around it.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        # Small star: a node and its smaller neighbours turn to the smallest of them.
        large = materialize(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        now = materialize(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct(),
            "edges",
        )
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
