"""Connected components of an edge table, in Spark alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.tables import narrow, stored


def _both_ways(u: Column, v: Column) -> Column:
    return F.explode(F.array(F.struct(u.alias("u"), v.alias("v")), F.struct(v.alias("u"), u.alias("v")))).alias("e")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end of the distinct edges (u > v) is in one edge only: then no step changes them."""
    ends = edges.select(_both_ways(F.col("u"), F.col("v"))).select("e.u", (F.col("e.u") > F.col("e.v")).cast("int").alias("up"))
    counts = ends.groupBy("u").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return not counts.where("up > 1 OR (up = 1 AND n > 1)").count()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (u, v): label is the smallest node that it reaches.

    Large-star and small-star steps in turn, until the edges are stars. Each step is a pre-aggregated minimum by node and a
    join, so that a hot centre is split by the adaptive skew join; each pair of steps is written out. Edges that are stars
    already cost a count of their ends, no step. Null ends are ignored.
    """
    clean = edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now = stored(narrow(clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()), "edges")
    while not _are_stars(now):
        # large star: every larger neighbour of a node goes to the smallest of the node and its neighbours
        both = now.select(_both_ways(F.col("u"), F.col("v"))).select("e.u", "e.v")
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: every smaller neighbour of a node, and the node, go to the smallest neighbour
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stored(narrow(small.select("e.u", "e.v").where("u <> v").distinct()), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select("v", "v").distinct())
