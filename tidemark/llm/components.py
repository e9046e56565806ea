"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each neighbour of a node to the least node around it: with ``large`` the
    neighbours above the node, else the node itself and those below."""
    around = (edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
              if large else
              edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("low"))
    least = least.select(F.col("u").alias("node"), F.least("u", "low").alias("low"))
    joined = around.join(least, around["u"] == least["node"])
    moved = joined.filter(F.col("v") > F.col("u")) if large else joined
    links = moved.select(F.col("v").alias("u"), F.col("low").alias("v"))
    if not large:
        links = links.unionByName(least.select(F.col("node").alias("u"), F.col("low").alias("v")))
    return links.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for each node of an edge.

    ``edges`` has bigint columns ``u`` and ``v``. Every round is written to the shared
    folder, which also cuts lineage; rounds grow with the logarithm of the longest path.
    """
    links = stored(edges.filter("u <> v").distinct(), "links")
    mark = None
    while True:
        links = stored(_star(_star(links, True), False), "links")
        # Large and small stars in turn end in one star for each component.
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == now:
            break
        mark = now
    return (links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")))
            .distinct())
