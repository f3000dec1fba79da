"""Connected components of a graph whose edges are rows, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingloom.session import spool


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of each node, and the node, to the smallest of them; edges lead from u down to v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
    return linked.union(least.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down at most, and none if it has one from above."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not seen.filter("down > 1 OR (down = 1 AND up = 1)").take(1)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node that can be reached, for every node of an edge (``u``, ``v``).

    Each step is written to the shared folder, so the lineage stays short; stars with any centre are done after one step.
    """
    now = spool(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    while not _are_stars(now):
        now = spool(_small_star(_large_star(now)), "edges")
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
