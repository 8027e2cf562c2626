"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotledger.session import materialise


def _mark(edges: DataFrame) -> tuple:
    """Tells whether a round has changed anything."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _lowest(links: DataFrame) -> DataFrame:
    """Each node with the smallest of itself and its neighbours; partial minima keep hubs cheap."""
    return links.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of links ``a, b``; a component is its smallest node.

    Every round hangs nodes below the smallest neighbour, which halves the depth of what is
    left; links to the same node collapse. Rounds are stored, so a lost executor costs only
    the round it was in. Loops, repeated links and an empty table are fine.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_lowest(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = materialise(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = materialise(small.unionByName(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct(), "small-star")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
