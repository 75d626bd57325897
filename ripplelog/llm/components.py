"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node that can be reached) for every node of edges (a long, b long).

    Large stars and small stars take turns until nothing moves: each links a node's neighbours to the smallest of them.
    Only minima are grouped, so a node with very many neighbours is no burden. Loops and nulls are left out.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = large.where("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("x"), "a", "m")
        small = small.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = stage(small.where("a <> b").distinct())
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            return edges.groupBy("a").agg(F.min("b").alias("c")).select(F.col("a").alias("node"), F.col("c").alias("component")).union(edges.select("b", "b").distinct())
        before = now
