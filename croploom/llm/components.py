"""Connected components of an edge list, in rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from croploom.session import materialise


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node of its component.

    Alternating large-star and small-star steps: neighbours hang themselves under the smallest known
    one until every component is a star.  The number of rounds grows with the logarithm of the longest
    path.  The smallest neighbour is aggregated and stored before it is joined back, so that the join may
    split the neighbours of one node over tasks.
    """
    now = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before, state = None, _state(now)
    while state != before and state[0]:
        near = _both(now)
        low = materialise(near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "lowest")
        large = near.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "edges")
        low = materialise(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        small = small.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        now = materialise(small, "edges")
        before, state = state, _state(now)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
