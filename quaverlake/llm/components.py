"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node reachable.

    Every round rewires edges to the smallest neighbour; the number of rounds grows with
    the logarithm of the nodes. Each round is written to the shared folder, so a lost
    executor costs that round only, and the round before is deleted. No group is gathered in one task: a node's smallest
    neighbour is an aggregate, and joins of a popular node can be split.
    """
    work = common.Scratch(edges.sparkSession)

    def staged(df: DataFrame, n: int) -> tuple[DataFrame, tuple]:
        """The round's edges, and their number and a sum of their hashes, which the same job counts."""
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h"))
        return work.stage(df, f"{tag}-{n}"), (seen.get["n"], seen.get["h"])

    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    (edges, now), before, n = staged(edges, 0), None, 0
    while now != before:
        # Large star: every larger neighbour of u points to the smallest neighbour of u (or u).
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its smaller neighbours point to the smallest of them.
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = small.select("u", F.col("m").alias("v")).union(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        n, before = n + 1, now
        edges, now = staged(small.distinct(), n)
        work.drop(f"{tag}-{n - 1}")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
