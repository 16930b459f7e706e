"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
                              ).first())


def connected(links: DataFrame) -> DataFrame:
    """`links` (a, b) of comparable ids -> (node, root), root the smallest node reachable.

    Only nodes that have a link come out; links with a null end and links of a node to itself
    say nothing. Each round hangs larger neighbours, then smaller ones, on the smallest
    neighbour (two aggregations per round, about log n rounds) and is written to the shared
    folder, so that a lost executor repeats one round at most. The driver sees a count and a
    checksum per round.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        hung = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"),
                                                          F.col("low").alias("b")).distinct())
        low = hung.groupBy("a").agg(F.min("b").alias("low"))
        edges = written(
            hung.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(low.select("a", F.col("low").alias("b"))).distinct(), "links")
        state, before = _state(edges), state
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
