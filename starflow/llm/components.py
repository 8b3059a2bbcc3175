"""Connected components by alternating large and small stars.

Every round replaces links by shorter ones to smaller nodes, until each component is one
star around its smallest node. Rounds grow with the logarithm of the longest chain. Each
round is stored, which cuts the lineage; links never leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.sources.workspace import Workspace


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    moved = both.where("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Links have a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, workspace: Workspace) -> DataFrame:
    """(node, root) for every node with a link, other than the roots themselves.

    ``links`` has two columns of one orderable type; loops are ignored. The root is the
    smallest node of the component. An empty table gives an empty result.
    """
    links = links.toDF("a", "b").where("a <> b")
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = workspace.store(links, "links")
    mark = _mark(links)
    while mark[0]:
        links = workspace.store(_small_star(_large_star(links)), "links")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _mark(links: DataFrame) -> tuple:
    """Two numbers that change when the set of links does."""
    both = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(both)).first())
