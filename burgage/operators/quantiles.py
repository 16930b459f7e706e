"""Exact quantiles by counting.

Spark's `percentile` keeps every distinct value of a group in one task. That is fine where the
values come from a bounded range, such as days between 0 and 1000. For free values this module
narrows down: every number has a 64-bit code that rises with it, values are counted by the leading
bits of their codes, the bins that hold a wanted position are found from the counts, and their values
are counted by more bits. The number of rounds is fixed, and so is the size of what a task can hold,
however the values are spread: a bin falls into 2^20 parts at most, and the last step, value by
value, sees 64 values of a bin. Only counts move.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# bits of a code that are left out in each round
_ROUNDS = (46, 26, 6)


def histogram(df: DataFrame, value: str, keys: Sequence[str] = (), n: str = "n") -> DataFrame:
    """Rows per (keys, value), NULL and NaN values left out. A hot key spreads over its values."""
    v = F.col(value)
    kind = df.schema[value].dataType.typeName()
    present = v.isNotNull() & ~F.isnan(v) if kind in ("double", "float") else v.isNotNull()
    return df.filter(present).groupBy(*keys, value).agg(F.count("*").alias(n))


def _code(value: Column) -> Column:
    """A bigint that rises with the value as a double: its sign, exponent and 52 bits of fraction."""
    size = F.abs(value.cast("double"))

    def power(exponent: Column) -> Column:
        return F.pow(F.lit(2.0), exponent.cast("double"))

    near = F.greatest(F.floor(F.log2(size)), F.lit(-1023))  # may be one off through rounding
    exponent = (near - F.when(power(near) > size, 1).otherwise(0)
                + F.when(power(near + 1) <= size, 1).otherwise(0))
    # The smallest numbers have no leading one; their scale is that of exponent -1022.
    usual = (exponent + 1023) * (1 << 52) + F.floor((size / power(exponent) - 1) * float(1 << 52))
    code = (F.when(size == float("inf"), F.lit(2047 << 52))
            .when(size < 2.0 ** -1022, F.floor(size * 2.0 ** 1022 * float(1 << 52)))
            .otherwise(usual))
    return F.when(value == 0, F.lit(0)).when(value < 0, -code).otherwise(code).cast("bigint")


def _positions(probs: Sequence[float]) -> list[tuple[Column, Column, Column]]:
    """For each probability: the 0-based position below, the one above, and the way between."""
    out = []
    for p in probs:
        exact = F.lit(float(p)) * (F.col("_total") - 1).cast("double")
        below = F.floor(exact)
        out.append((below, F.ceil(exact), exact - below))
    return out


def _holds(position: Column) -> Column:
    return (F.col("_before") <= position) & (position < F.col("_before") + F.col("_n"))


def _narrowed(
    counts: DataFrame, group: list[str], spots: list[tuple[Column, Column, Column]]
) -> tuple[DataFrame, list[str]]:
    """The values in the last bins that hold a wanted position, and the columns that name a bin.

    `_before` is the number of rows of the group before the bin, `_total` that of the group.
    """
    wanted = reduce(lambda a, b: a | b, [_holds(x) for s in spots for x in s[:2]])
    path = list(group)
    counts = counts.withColumn("_code", _code(F.col("_v")))
    for depth, left_out in enumerate(_ROUNDS):
        here = f"_bin{depth}"
        binned = counts.withColumn(here, F.shiftright("_code", left_out))
        before = F.lit(0) if depth == 0 else F.max("_before")
        earlier = W.partitionBy(*path).orderBy(here).rowsBetween(W.unboundedPreceding, -1)
        bins = binned.groupBy(*path, here).agg(
            F.sum("_n").alias("_n"), before.alias("_start"), *([] if depth == 0 else [F.max("_total").alias("_total")]))
        if depth == 0:
            bins = bins.withColumn("_total", F.sum("_n").over(W.partitionBy(*path)))
        bins = bins.withColumn(
            "_before", F.col("_start") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
        ).filter(wanted)
        path = [*path, here]
        kept = bins.select(*[F.col(c).alias("_r" + c) for c in path], "_before", "_total")
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col("_r" + c)) for c in path])
        counts = binned.select(*path, "_v", "_n", "_code").join(kept, same) \
            .drop(*["_r" + c for c in path])
    return counts, path


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    keys: Sequence[str] = (),
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per key group, one double column per probability.

    A group without any value has no row, but without keys there always is one. NULL keys form
    a group. Nothing runs before the result is asked for.
    """
    return quantiles_of_counts(histogram(df, value, keys, "_n"), value, "_n", probs, keys, names)


def quantiles_of_counts(
    counts: DataFrame,
    value: str,
    n: str,
    probs: Sequence[float],
    keys: Sequence[str] = (),
    names: Sequence[str] | None = None,
) -> DataFrame:
    """The same from a table that has each value of a group once, with its number of rows."""
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    group = [f"_k{i}" for i in range(len(keys))]
    spots = _positions(probs)
    near, path = _narrowed(counts.select(
        *[F.col(k).alias(g) for k, g in zip(keys, group)], F.col(value).alias("_v"),
        F.col(n).alias("_n")), group, spots)
    smaller = W.partitionBy(*path).orderBy("_v").rowsBetween(W.unboundedPreceding, -1)
    placed = near.withColumn(
        "_before", F.col("_before") + F.coalesce(F.sum("_n").over(smaller), F.lit(0)))

    def at(position: Column) -> Column:
        return F.max(F.when(_holds(position), F.col("_v").cast("double")))

    found = placed.groupBy(*group).agg(
        *[at(below).alias(f"_lo{i}") for i, (below, _, _) in enumerate(spots)],
        *[at(above).alias(f"_hi{i}") for i, (_, above, _) in enumerate(spots)],
        *[F.max(way).alias(f"_way{i}") for i, (_, _, way) in enumerate(spots)])
    return found.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], *[
        F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}"))
        .otherwise((1 - F.col(f"_way{i}")) * F.col(f"_lo{i}")
                   + F.col(f"_way{i}") * F.col(f"_hi{i}")).alias(name)
        for i, name in enumerate(names)])


def medians(df: DataFrame, values: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Exact medians of several columns per key group, found together.

    The columns are laid below each other with their name as a further key, and the medians are
    put side by side again. A column without any value in a group is NULL there; a group without
    any value at all has no row.
    """
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(v).alias("_column"), F.col(v).cast("double").alias("_value"))
        for v in values])).alias("_pair")).select(*keys, "_pair.*")
    by = [*keys, "_column"]
    found = quantiles_of_counts(histogram(long, "_value", by, "_n"), "_value", "_n", [0.5], by,
                                ["_median"])
    return found.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_column") == v, F.col("_median"))).alias(v) for v in values])
