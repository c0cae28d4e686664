"""Connected components by alternating large-star and small-star steps, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import Scratch


def starred(edges: DataFrame) -> bool:
    """Whether edges (u, v), u > v, are stars: no node has two smaller neighbours, or one and a larger one too."""
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("low")).unionByName(edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("low")))
    nodes = ends.groupBy("node").agg(F.min("low").alias("lo"), F.max("low").alias("hi"), F.max(F.col("low").isNull()).alias("centre"))
    return nodes.where("lo < hi or (lo is not null and centre)").isEmpty()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, comp): the smallest node reachable over edges (a, b), for every node that has an edge to another one.

    Each step keeps at most as many edges as there were; a hub's rows meet in joins that adaptive execution may
    split, and its minimum is pre-aggregated. Steps end when all edges are stars. Nothing goes to the driver but that answer.
    """
    now = scratch.table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    while not starred(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every edge now runs from a larger to a smaller node, so low holds each node's smaller neighbours only
        large = scratch.table(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        after = scratch.table(small)
        scratch.drop(now, large)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
