"""How long things take: day counts per category, their statistics and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DAYS_RANGE, TOP_TIMING_TYPES
from .quantiles import histogram, quantiles_of_counts
from .ranking import keep_top_categories


def processing_time(
    df: DataFrame, *, category: str = "permit_type", days: str = "processing_days",
    days_range: tuple[int, int] = DAYS_RANGE,
) -> DataFrame:
    """(category, days) of every row whose day count lies in the range, bounds included."""
    return df.filter(F.col(days).between(*days_range)).select(category, days)


def processing_stats(
    df: DataFrame, *, category: str = "permit_type", days: str = "processing_days",
    digits: int = 1, approx: bool = False, whole_days: bool = True,
) -> DataFrame:
    """Rows, mean, median, least and most days per category, in no stored order.

    Rows are counted per (category, days) first. Whole days take few distinct values, so all
    figures, the exact median included, come from that small table; sums stay whole numbers.
    For other measures, which may differ in every row, `whole_days=False` finds the exact median
    in rounds and `approx` an approximate one.
    """
    if approx:
        return df.groupBy(category).agg(
            F.count("*").alias("count"),
            F.round(F.avg(days), digits).alias("avg_days"),
            F.percentile_approx(days, 0.5).cast("double").alias("median_days"),
            F.min(days).alias("min_days"),
            F.max(days).alias("max_days"))
    per_day = df.groupBy(category, days).agg(F.count("*").alias("_n"))
    timed = F.sum(F.when(F.col(days).isNotNull(), F.col("_n")))
    mean = F.try_divide(F.sum(F.col(days) * F.col("_n")).cast("double"), timed)
    figures = [F.sum("_n").alias("count"), F.round(mean, digits).alias("avg_days"),
               F.min(days).alias("min_days"), F.max(days).alias("max_days")]
    if whole_days:
        return per_day.groupBy(category).agg(
            *figures[:2], F.percentile(F.col(days), 0.5, F.col("_n")).alias("median_days"),
            *figures[2:])
    middle = quantiles_of_counts(per_day.filter(F.col(days).isNotNull()), days, "_n", [0.5],
                                 [category], ["median_days"])
    middle = middle.withColumnRenamed(category, "_category")
    found = per_day.groupBy(category).agg(*figures)
    return found.join(middle, found[category].eqNullSafe(middle["_category"]), "left").select(
        category, "count", "avg_days", "median_days", "min_days", "max_days")


def processing_time_top_types(
    df: DataFrame, k: int = TOP_TIMING_TYPES, *, category: str = "permit_type"
) -> DataFrame:
    """Rows of the k most frequent categories."""
    return keep_top_categories(df, category, k)


def box_summary(
    df: DataFrame, value: str, category: str, *, k: int | None = None,
    bounded_values: bool = False,
) -> DataFrame:
    """Quartiles, whiskers and outliers per category, optionally of the k most frequent ones.

    Whiskers end at the last values within 1.5 interquartile ranges of the box. Everything is
    computed from rows counted per (category, value). `bounded_values` says that the values come
    from a small fixed range, so that a category's distinct values fit in one task; otherwise
    the quartiles are found in rounds.
    """
    counts = histogram(df.filter(F.col(category).isNotNull()), value, [category], "_n")
    if k is not None:
        counts = keep_top_categories(counts, category, k, "_n")
    names = ["q1", "median", "q3"]
    if bounded_values:
        box = (counts.groupBy(category)
               .agg(F.percentile(F.col(value), F.array(*map(F.lit, (0.25, 0.5, 0.75))),
                                 F.col("_n")).alias("_q"))
               .select(category, *[F.col("_q")[i].alias(q) for i, q in enumerate(names)]))
    else:
        box = quantiles_of_counts(counts, value, "_n", (0.25, 0.5, 0.75), [category], names)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return counts.join(box, category).groupBy(category, *names).agg(
        F.sum("_n").alias("row_count"),
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outliers"))
