"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around that node."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    own = least.select((F.col("a") + F.lit(0)).alias("a"), "m")
    return both.join(own, "a").where("b > a").select(F.col("b").alias("b"), F.col("m").alias("a"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    own = least.select((F.col("b") + F.lit(0)).alias("b"), "m")
    near = edges.join(own, "b").select(F.col("a").alias("b"), F.col("m").alias("a"))
    return near.unionByName(least.select("b", F.col("m").alias("a")))


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): each node that has a link, with the smallest node of its component.

    `links` has columns a and b, in either order, repeats allowed. Each round works on narrow rows
    with partial minima, and is written, so that a lost executor costs no more than one round. The
    rounds needed grow with the logarithm of the number of nodes; if `most_rounds` were not enough
    an error is raised rather than a wrong result returned.
    """
    edges = links.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    edges = materialise(edges.distinct(), "links")
    before = None
    for _ in range(most_rounds):
        large = _large_star(edges).where("a <> b").distinct()
        edges = materialise(_small_star(large.select("a", "b")).where("a <> b").distinct(), "links")
        # Stars only: no node is both a centre and a member.
        state = edges.agg(
            F.count("*"), F.coalesce(F.sum(F.hash("a", "b").cast("long")), F.lit(0))
        ).first()
        if state == before:
            stars = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
            centres = edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
            return stars.unionByName(centres.distinct())
        before = state
    raise RuntimeError("components did not settle")
