"""Connected components of an edge table by alternating stars, with lineage cut each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrill.llm.base import staged


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` for each end of the edges ``a``, ``b`` (longs): the least node it reaches.

    Large star: a node's greater neighbours move to the least of its neighbourhood. Small star:
    its smaller ones do. Neighbourhoods are only aggregated to a minimum, never gathered, and
    rounds (about the logarithm of the longest path) end when the edges no longer change. Loops and
    nulls are dropped; an empty table gives an empty one.
    """
    now = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # now every edge goes from a node to a smaller one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        new = staged(small, "edges")
        # stars only: each node has one edge, and no centre has one of its own
        if new.exceptAll(now).isEmpty() and now.exceptAll(new).isEmpty():
            centres = new.select("b").distinct()
            return new.select(F.col("a").alias("node"), F.col("b").alias("label")).union(centres.select("b", "b"))
        now = new
