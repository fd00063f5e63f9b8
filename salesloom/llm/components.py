"""Connected components of a graph given by its links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(links: DataFrame) -> DataFrame:
    """The smallest neighbour of each node; sums up before the shuffle, so a hub is no hot key."""
    return links.groupBy("a").agg(F.min("b").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to its smallest one."""
    ways = _both_ways(links)
    roots = _least(ways).select("a", F.least("a", "least").alias("root"))
    return ways.where("b > a").join(roots, "a").select(F.col("root").alias("a"), "b")


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    roots = _least(down).withColumnRenamed("least", "root")
    moved = down.join(roots, "a").where("b <> root").select(F.col("root").alias("a"), "b")
    return moved.unionByName(roots.select(F.col("root").alias("a"), F.col("a").alias("b")))


def _settled(links: DataFrame) -> bool:
    """Whether each node hangs on one root only and no root hangs on another."""
    ends = links.select(F.col("a").alias("node"), F.lit(0).alias("hangs")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(1).alias("hangs"))
    )
    counts = ends.groupBy("node").agg(F.count("*").alias("n"), F.sum("hangs").alias("hangs"))
    return counts.where("hangs > 1 or (hangs = 1 and n > 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node with a link.

    ``links`` has the columns ``a`` and ``b``, ids of any sortable type; order,
    repeats, self-links and nulls do not matter.  Each round is written to the
    shared folder; the rounds grow with the logarithm of the longest path.
    """
    links = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = stored(links, "links")
    while not _settled(links):
        links = stored(_small_star(_large_star(links).distinct()).distinct(), "links")
    hanging = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return hanging.unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
