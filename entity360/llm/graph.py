"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entity360.llm.common import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links from the neighbours of each node to the least of them.

    large: from the neighbours above the node; else from those below it and from the node.
    The least neighbour is found by an aggregate that combines before the shuffle, so a node
    with a third of all links is no single task.
    """
    pairs = _both_ways(links)
    if not large:
        pairs = pairs.where("b < a")
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    if large:
        out = pairs.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = (
            pairs.join(least, "a")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .union(least.select("a", F.col("least").alias("b")))
        )
    return out.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); component: the least node.

    Each round is written to the shared folder, so lineage stays short.
    """
    state = written(links.select("a", "b").where("a != b").distinct(), "links")
    before = None
    while True:
        mark = state.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if before == mark:
            break
        before = mark
        state = written(_star(_star(state, large=True), large=False), "links")
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
