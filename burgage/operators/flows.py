"""Flows between two labels of a row, and their node-and-link form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import initcap_words
from ..schemas import TOP_FLOWS
from ..session import written


def change_of_use(
    df: DataFrame, k: int | None = TOP_FLOWS, *, source: str = "existing_use",
    target: str = "proposed_use", normalise: str = "after", initcap_mode: str = "punctuation",
    name: str = "flow_count",
) -> DataFrame:
    """Rows per (source, target) with source and target different as written, the k largest.

    normalise="after" groups by the labels as written and capitalises the result, so spellings
    that differ in case stay separate rows. normalise="before" groups by the capitalised labels:
    spellings merge, and a flow such as office -> OFFICE remains as a loop. Either way rows are
    first counted as written, so each distinct pair is capitalised once, not each row.
    """
    if normalise not in ("before", "after"):
        raise ValueError(f"unknown normalise {normalise!r}")
    counts = (
        df.filter(F.col(source) != F.col(target))
        .groupBy(source, target).agg(F.count("*").alias(name))
    )
    nice = [initcap_words(c, initcap_mode).alias(c) for c in (source, target)]
    if normalise == "before":
        merged = counts.select(*nice, name).groupBy(source, target).agg(F.sum(name).alias(name))
        return merged if k is None else merged.orderBy(F.desc(name), source, target).limit(k)
    if k is not None:
        counts = counts.orderBy(F.desc(name), source, target).limit(k)
    return counts.select(*nice, name)


def _largest(edges: DataFrame, k: int | None, source: str, target: str, amount: str) -> DataFrame:
    return edges if k is None else edges.orderBy(F.desc(amount), source, target).limit(k)


def _numbered(df: DataFrame, order: str) -> DataFrame:
    """`df` with node_id from 0 in the order of the column `order`.

    Rows are dealt to tasks by ranges of the whole order, whose cuts come from a sample, so no label
    and no amount can crowd a task. Each row is numbered in its range, and a running total of
    the ranges' sizes, a row per task, says where a range begins. The ranges are written once, at
    once, so that sizes and numbers are of the same ones.
    """
    ranges = written(df.repartitionByRange(order).sortWithinPartitions(order)
                     .withColumn("_at", F.monotonically_increasing_id()), "numbered")
    ranges = ranges.select("*", F.shiftright("_at", 33).alias("_range"),
                           F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    first = (ranges.groupBy("_range").agg(F.count("*").alias("_n"))
             .select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin")))
    return (ranges.join(first, "_range").withColumn("node_id", F.col("_begin") + F.col("_place"))
            .drop("_at", "_range", "_place", "_begin"))


def sankey_nodes(
    edges: DataFrame, k: int | None = None, *, source: str = "existing_use",
    target: str = "proposed_use", amount: str = "flow_count",
) -> DataFrame:
    """Numbered labels of all edges, or of the k largest: sources in order of first appearance,
    then the targets that are no sources. Edges appear by amount, largest first, then by their
    labels. Ids start at 0."""
    def end(side: int, label: str):
        return F.struct(F.lit(side).alias("side"), (-F.col(amount)).alias("less"),
                        F.col(source).alias("begin"), F.col(target).alias("end"),
                        F.col(label).alias("label"))

    ends = _largest(edges, k, source, target, amount) \
        .select(F.inline(F.array(end(0, source), end(1, target))))
    first = ends.groupBy("label").agg(F.min(F.struct("side", "less", "begin", "end")).alias("_first"))
    return _numbered(first, "_first").select("node_id", "label")


def sankey_links(
    edges: DataFrame, k: int | None = None, *, source: str = "existing_use",
    target: str = "proposed_use", amount: str = "flow_count",
) -> DataFrame:
    """All edges, or the k largest, with their ends as node ids.

    The edges are found once, at once, and written; nodes and links both come from there.
    """
    edges = written(_largest(edges, k, source, target, amount), "edges")
    nodes = sankey_nodes(edges, source=source, target=target, amount=amount)
    begin = nodes.select(F.col("node_id").alias("source_id"), F.col("label").alias(source))
    end = nodes.select(F.col("node_id").alias("target_id"), F.col("label").alias(target))
    return (
        edges.join(begin, source).join(end, target)
        .select("source_id", "target_id", F.col(amount).alias("value"))
    )
