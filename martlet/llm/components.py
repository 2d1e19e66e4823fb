"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martlet.llm.tables import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect each larger neighbour of a node with the least of its neighbourhood."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours with the least of them (``v`` is always the smaller end)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node that has a link.

    ``links`` has columns ``u`` and ``v``; loops and repeated links don't matter.
    Each round is two grouped minima and two joins on node keys. It ends when a
    round leaves the edge set as it was; the edges then are stars.
    """
    edges = store(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")

    def print_of(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = print_of(edges)
    while before[0]:
        edges = store(_small_star(_large_star(edges)), "edges")
        now = print_of(edges)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
