"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.llm.common import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of `links` (a, b).

    Alternates two steps until nothing changes: each node hangs its larger neighbours on its smallest
    neighbour, then its smaller ones. The number of rounds grows with the logarithm of
    the longest path. Smallest neighbours are found with partial aggregates, and the joins that follow
    only repeat that one row, so the adaptive skew join can split a node of any degree. Every
    round is written to the shared folder.
    """
    state = written(links.where("a <> b").distinct(), "links")
    seen = None
    while True:
        print_of = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(print_of) == seen:
            break
        seen = tuple(print_of)
        both = _both_ways(state)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "links-large")
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        state = written(small.unionByName(lower.select("a", F.col("m").alias("b"))).distinct(), "links")
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
