"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of edges (a, b): root is the least node of its component.

    Each round hangs the neighbours of a node onto the least of them, first the larger ones, then the smaller ones. Every
    step is an aggregate and a join, so a node with very many neighbours is split like any skewed join; the rounds grow with
    the logarithm of a component's width. Rounds are written, so lost executors do not undo them. Null nodes and loops are
    left out; repeated edges count once.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a > b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.unionByName(least.withColumnRenamed("m", "b")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
