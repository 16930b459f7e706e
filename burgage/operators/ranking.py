"""Top-k, ranks, shares and samples that hold no more than a bounded set in any task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written

# hex digits of the sample hash that are counted: 16**5 bins
_HASH_DIGITS = 5

# bins that categories are counted by before any is counted by itself
_BINS = 1 << 16


def top_categories(df: DataFrame, category: str, k: int, weight: str | None = None) -> DataFrame:
    """The k categories with the largest summed weight (or most rows), ties by name; NULL is none.

    A weight that is NULL throughout sums to 0.
    """
    score = F.count("*") if weight is None else F.coalesce(F.sum(weight), F.lit(0))
    return (
        df.filter(F.col(category).isNotNull())
        .groupBy(category).agg(score.alias("score"))
        .orderBy(F.desc("score"), F.asc(category)).limit(k)
    )


def top_by_threshold(df: DataFrame, category: str, k: int, bins: int = _BINS) -> DataFrame:
    """`top_categories` by rows, for categories so many that counting each would shuffle most rows.

    Three passes over the one column. Categories are counted by bins of their hash, at most `bins` rows
    from a task; no category has more rows than its bin. Those in the fullest bins are then counted
    exactly, and the k-th of them is a lower bound: only bins that reach it can hold one of the k.
    The last pass counts the categories of those. Bins, not categories, are broadcast, `bins` at most.
    Runs the first two passes at once.
    """
    known = df.filter(F.col(category).isNotNull()).select(category)
    binned = known.withColumn("_bin", F.pmod(F.xxhash64(category), F.lit(bins)))
    sizes = written(binned.groupBy("_bin").agg(F.count("*").alias("_n")), "bins")

    def counted(chosen: DataFrame) -> DataFrame:
        rows = binned.join(F.broadcast(chosen.select("_bin")), "_bin", "left_semi")
        return top_categories(rows, category, k)

    first = counted(sizes.orderBy(F.desc("_n"), "_bin").limit(2 * k)).agg(
        F.count("*").alias("found"), F.min("score").alias("least")).first()
    if first["found"] < k:
        return top_categories(known, category, k)
    return counted(sizes.filter(F.col("_n") >= first["least"]))


def keep_top_categories(
    df: DataFrame, category: str, k: int, weight: str | None = None
) -> DataFrame:
    """Rows of the k top categories.

    Both sides start from the same filtered rows, and the list is joined instead of
    semi-joined, so that Spark can compute what `df` stands for once and use it twice.
    """
    known = df.filter(F.col(category).isNotNull())
    top = top_categories(known, category, k, weight).select(category)
    return known.join(top, category).select(*df.columns)


def value_counts(df: DataFrame, column: str, name: str = "row_count") -> DataFrame:
    """Rows per value, NULL left out."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(name))


def rank_within(
    df: DataFrame, group: Sequence[str], score: str, name: str = "rank"
) -> DataFrame:
    """RANK() by descending score within each group: ties share a rank and gaps follow.

    Rows are not sorted group by group. Rows are counted per (group, score), the running total
    over the *distinct scores* gives each score its rank, and the rank is joined back. Scores
    that are themselves counts take few distinct values: a group with N underlying rows has at
    most about sqrt(2N), however many rows it has here.
    """
    by_score = df.groupBy(*group, score).agg(F.count("*").alias("_tied"))
    ahead = W.partitionBy(*group).orderBy(F.desc(score)).rowsBetween(W.unboundedPreceding, -1)
    ranks = by_score.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col(score).alias("_score"),
        (F.coalesce(F.sum("_tied").over(ahead), F.lit(0)) + 1).alias(name))
    same = F.col(score).eqNullSafe(F.col("_score"))
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return df.join(ranks, same).select(*df.columns, name)


def with_share(df: DataFrame, amount: str, name: str = "share") -> DataFrame:
    """Each row's part of the column total. The total is one number, read as a scalar subquery."""
    total = df.groupBy().agg(F.sum(amount).cast("double")).scalar()
    return df.withColumn(name, F.col(amount).cast("double") / F.nullif(total, F.lit(0.0)))


def _row_hash(keys: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("~", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
                 .cast("binary"))


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly n rows (or all, if fewer), the same on every run: those with the smallest hash.

    `keys` must tell rows apart. `df` is evaluated twice. Sorting for the n smallest would have every task send n rows to
    the last one, so the hashes are first counted by their leading digits, at most 16**5 counts;
    the digits at which n rows are reached cut off all but about n rows before the sort.
    """
    hashed = df.withColumn("_hash", _row_hash(keys, seed))
    lead = F.substring("_hash", 1, _HASH_DIGITS)
    bins = hashed.groupBy(lead.alias("_lead")).agg(F.count("*").alias("_n"))
    before = W.orderBy("_lead").rowsBetween(W.unboundedPreceding, -1)
    cut = (
        bins.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .filter(F.col("_before") < n)
        .groupBy().agg(F.max("_lead")).scalar()
    )
    return (
        hashed.filter(lead <= cut)
        .orderBy("_hash", *keys).limit(n)
        .drop("_hash")
    )


def ranked_bar(df: DataFrame, amount: str, label: str, ascending: bool = False) -> DataFrame:
    """Rows in bar order, ties by label."""
    return df.orderBy(F.asc(amount) if ascending else F.desc(amount), F.asc(label))
