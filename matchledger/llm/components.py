"""Connected components of an edge table, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchledger.llm.common import Scratch, cut


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (node, root): the smallest node reachable, for every node that has an edge to another one.

    Each round makes every node point to a smaller neighbour of its neighbours; the rounds grow with the logarithm of
    a component's length. Each round ends in a written table, so lineage stays short and a lost executor costs a round
    at most. The least neighbours of a round are a table as well: they come from partial minima, and their join with the
    edges has a shuffle of its own, so that Spark splits a hub with many edges."""
    with Scratch(edges.sparkSession) as at:
        now = at.cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
        mark = _mark(now)
        while mark[0]:
            both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = at.cut(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
            large = at.cut(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
            least = at.cut(large.groupBy("u").agg(F.min("v").alias("m")), "least")
            joined = large.join(least, "u")
            small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(joined.select("u", F.col("m").alias("v")))
            now = at.cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
            before, mark = mark, _mark(now)
            if before == mark:
                break
        ends = now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")))
        return cut(ends.groupBy("node").agg(F.min("root").alias("root")), "roots")


def _mark(edges: DataFrame) -> tuple:
    """A count and a sum that tell whether a round has changed the edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
