"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges(a, b): component is the smallest node it reaches.

    Null ends and loops are ignored, repeated edges count once, no edges give no rows. Every round
    is a few joins and aggregations whose result is stored in the shared folder; only a row count and
    a checksum come to the driver. A node with very many neighbours meets its minimum through a
    partial aggregation and a join whose skewed partitions adaptive execution splits.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                e.select("b", "b").distinct()
            )
        seen = now
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        e = stored(e, "large-star")
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        below = e.join(least, "a")
        e = below.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(below.select("a", "m"))
        e = stored(e.distinct(), "small-star")
