"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Each round hangs larger neighbours on the smallest neighbour, then smaller ones too; rounds grow with the logarithm
    of the longest path. A hub's neighbours are joined to one row, which adaptive execution splits.
    """
    spark = edges.sparkSession
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a")
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(hung.select("a", F.col("m").alias("b")))
        edges = stored(small.filter("a <> b").distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    if not before[0]:
        return spark.createDataFrame([], "node long, component long")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)
