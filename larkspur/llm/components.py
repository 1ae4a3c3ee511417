"""Connected components of links, as rounds of joins.

Each round points every node's neighbours at its smallest neighbour, first the
larger ones and then the smaller ones (alternating large and small stars), so that
long chains shorten fast and hubs never gather their neighbours in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import materialize


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link: the smallest node reachable.

    Links of a node with itself and repeated links change nothing. What is
    collected is one row of sums for each round.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    edges = materialize(edges, "edges")
    before = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        large = _large(edges).filter("u <> v").distinct()
        edges = materialize(_small(large).filter("u <> v").distinct(), "edges")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
