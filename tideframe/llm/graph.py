"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tideframe.llm.common import discard, written


def components(edges: DataFrame) -> DataFrame:
    """node, root: for each node of the edges (a, b; longs), the least node that it is connected with.

    Alternates the large-star and small-star steps: every node's greater neighbours, then its smaller ones, are hung on
    the least neighbour. Each step is an aggregation and a join on the node, so no neighbourhood is ever gathered, and a
    round's edges are written, which cuts the lineage, and those of the round before deleted. The rounds grow with the
    logarithm of a component's size.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges, old = written(small.unionByName(down.select("a", F.col("m").alias("b"))).distinct()), edges
        discard(old)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    roots = edges.groupBy("a").agg(F.min("b").alias("root"))
    out = written(roots.select(F.col("a").alias("node"), "root").unionByName(roots.select(F.col("root").alias("node"), "root").distinct()))
    discard(edges)
    return out
