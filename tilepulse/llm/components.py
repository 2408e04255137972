"""Connected components of a graph given as links, as Spark joins.

Alternating large-star and small-star steps (each a minimum per node and one equi-join) until
the edges stop changing: the number of rounds grows with the logarithm of the longest chain.
Every round is a table in the shared folder. Nothing is collected but one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _checksum(edges: DataFrame) -> tuple:
    """Count and hash sum: equal for equal edge sets."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h)).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v) with v < u. Large star: the larger neighbours of each node (and small star:
    the smaller ones, and the node) are linked to the smallest of its neighbourhood."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of one type, nulls and self-links ignored: every node that has a link,
    with ``root``, the smallest node of its component."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "links")
    before = _checksum(edges)
    while before[0]:
        edges = written(_star(_star(edges, large=True), large=False), "star")
        after = _checksum(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
