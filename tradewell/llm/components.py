"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewell.llm.common import stored


def _pull(edges: DataFrame, least: DataFrame) -> DataFrame:
    # both sides are tables of their own, so that a hub's edges can be split by AQE
    return edges.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (columns u, v: longs):
    component is the least node reachable. Every round writes its tables to the
    shared folder; rounds grow with the logarithm of the longest path."""
    edges = stored(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                   "links")
    mark = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large-star")
        large = _pull(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        large = stored(large.distinct(), "links")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        pulled = _pull(large, least)
        small = pulled.select(F.col("v").alias("u"), F.col("m").alias("v")).union(pulled.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u != v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
    return stored(edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
                  .union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct(), "components")
