"""Connected components of an edge table, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bramble.llm.shared import checkpoint


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Alternates two steps until the edges stay as they are: every node links its larger
    neighbours to its smallest one, then every node links its smaller neighbours and itself
    to the smallest of them. The number of edges never grows; each step takes one aggregate
    with map-side combine and one join on the node, which Spark splits where a node is hot.
    Edges are checkpointed in the shared folder each round. Self-links and nulls are
    ignored, repeated links count once, an empty table gives an empty result."""
    links = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    before = _mark(links)
    while True:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("hi"), F.least("m", "u").alias("lo")).where("hi <> lo").distinct())
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(down, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(down.select("hi", F.col("m").alias("lo"))).distinct())
        links = checkpoint(small)
        after = _mark(links)
        if after == before:
            break
        before = after
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        links.select("lo", "lo")).distinct()


def _mark(links: DataFrame) -> tuple:
    """Number of links and two sums over them: equal when no link changed."""
    mark = F.xxhash64("hi", "lo")
    return tuple(links.agg(F.count("*"), F.sum(F.shiftright(mark, 16)), F.sum(mark.bitwiseAND(0xFFFFFFFF))).first())
