"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import drop_stored, stored


def components(links: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, component) for each node of the links (a, b); component: its smallest node.

    Alternates large and small stars: each node's larger neighbours, then its smaller ones, are
    hung onto its least neighbour, until every edge leads to a root. All steps are
    aggregates with partial results and equi joins; each round is written to the shared folder.
    """
    edges = links.select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    ).where("high > low")
    turn = 0
    edges = stored(edges.distinct(), folder, f"{name}-{turn}")
    while not _are_stars(edges):
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(
            edges.select("low", "high")
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("high"), F.col("m").alias("low"))
        large = large.distinct()
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high")
        hung = small.select(F.col("low").alias("high"), F.col("m").alias("low")).where("high <> low")
        turn += 1
        following = hung.union(small.select("high", F.col("m").alias("low"))).distinct()
        following = stored(following, folder, f"{name}-{turn}")
        drop_stored(edges.sparkSession, f"{folder}/{name}-{turn - 1}")
        edges = following
    leaves = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return leaves.union(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each higher node has one edge, and none is another edge's lower node."""
    several = edges.groupBy("high").count().where("count > 1").select("high")
    inner = edges.join(edges.select(F.col("high").alias("low")), "low", "left_semi").select("high")
    return several.union(inner).isEmpty()
