"""Connected components of a table of links, by alternating large and small stars.

Each round is a few aggregations and joins over the links; what a round made is
written before the next one reads it. A node with very many links is aggregated
per task first, and the joins read written tables, so its rows can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _least(edges: DataFrame) -> DataFrame:
    return materialise(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "star_least")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of the distinct ``edges`` (u > v) has one role: a centre, or a leaf of one centre."""
    role = lambda c, leaf: F.struct(F.col(c).alias("node"), F.lit(leaf).alias("leaf"))
    roles = edges.select(F.explode(F.array(role("u", 1), role("v", 0))).alias("r")).groupBy("r.node").agg(
        F.sum("r.leaf").alias("leaf"), F.min("r.leaf").alias("least"))
    return roles.filter((F.col("leaf") > 1) | ((F.col("leaf") == 1) & (F.col("least") == 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) -> ``node, component``: the smallest node reachable; nodes without links are absent."""
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .filter("u <> v").distinct(), "links")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large, "large_star")  # u > v throughout; a row per edge at most
        small = large.join(_least(large), "u")
        edges = materialise(small.select("u", F.col("m").alias("v")).unionByName(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "small_star")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
