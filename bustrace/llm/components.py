"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is an aggregate (with a map side) and a join on narrow rows, and its result is a written table, so neither a
node with very many links nor a lost executor matters. Links that are stars already need no round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bustrace.session import store


def _are_stars(links: DataFrame) -> bool:
    """Whether every larger end occurs once, and never as a smaller end."""
    ends = links.select(F.col("a").alias("x"), F.lit(0).alias("larger"))
    ends = ends.unionByName(links.select(F.col("b").alias("x"), F.lit(1).alias("larger")))
    times = ends.groupBy("x").agg(F.sum("larger").alias("larger"), F.count(F.lit(1)).alias("n"))
    return not times.agg(F.count_if(F.expr("larger > 0 and n > 1"))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); a component's name is its smallest node."""
    smaller, larger = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    links = store(links.filter("a != b").select(smaller, larger).distinct(), "links")
    while not _are_stars(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b")
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b")
        small = small.select(F.col("m").alias("a"), "b").unionByName(small.select(F.col("m").alias("a"), F.col("a").alias("b")))
        links = store(small.filter("a != b").distinct(), "links")
    nodes = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
