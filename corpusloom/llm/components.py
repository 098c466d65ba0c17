"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import saved


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has a link; ``component`` is the smallest node reachable.

    Each round replaces links by links to the smallest neighbour (first among larger neighbours, then among
    smaller ones) until the table no longer changes: a forest of stars around each component's smallest node.
    Links with a null end and links of a node to itself are ignored; an empty table gives no rows.
    Only minima are gathered per node, so a node with very many links is summed before the shuffle, and the
    joins back are plain equi-joins whose large partitions Spark splits.  Every round is written to the shared
    folder; the driver sees two numbers a round.
    """
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = edges.where("a is not null and b is not null and a <> b").distinct()
    edges, seen = _round(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select("a", F.col("m").alias("b")).unionByName(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        edges, now = _round(small)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _round(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = saved(edges, "links")
    sign = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return edges, tuple(sign)
