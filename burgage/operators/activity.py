"""Counts over time, places and categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import RANKING_YEARS, TOP_PLACES, TOP_TREND_TYPES, TREND_YEARS
from .ranking import rank_within, value_counts, with_share


def quality_summary(
    df: DataFrame, *, year: str = "issued_year", days: str = "processing_days",
    place: str = "neighborhood",
) -> DataFrame:
    """One row: rows, first and last year, mean days, distinct places."""
    # counted per place first, so the distinct count is a plain count of the partial rows
    per_place = df.groupBy(place).agg(
        F.count("*").alias("_n"), F.min(year).alias("_from"), F.max(year).alias("_to"),
        F.sum(days).alias("_days"), F.count(days).alias("_timed"))
    return per_place.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.min("_from").alias("min_year"), F.max("_to").alias("max_year"),
        F.try_divide(F.sum("_days").cast("double"), F.sum("_timed")).alias("avg_processing_days"),
        F.count(place).alias("distinct_neighborhoods"))


def trend(
    df: DataFrame, *, year: str = "issued_year", category: str = "permit_type",
    years: tuple[int, int] = TREND_YEARS, name: str = "permit_count",
) -> DataFrame:
    """Rows per (year, category) within the years, bounds included; a NULL category is a group."""
    return df.filter(F.col(year).between(*years)).groupBy(year, category) \
        .agg(F.count("*").alias(name))


def trend_top_types(
    counts: DataFrame, k: int = TOP_TREND_TYPES, *, year: str = "issued_year",
    category: str = "permit_type", amount: str = "permit_count",
) -> DataFrame:
    """The trend lines of the k categories with the largest totals.

    Counts are added up per category and year first, so a category's line is as short as the range
    of years and can travel with its total: no second look at the data is needed.
    """
    line = F.collect_list(F.struct(year, amount))
    return (
        counts.filter(F.col(year).isNotNull() & F.col(category).isNotNull())
        .groupBy(category, year).agg(F.sum(amount).alias(amount))
        .groupBy(category)
        .agg(F.coalesce(F.sum(amount), F.lit(0)).alias("_total"), line.alias("_line"))
        .orderBy(F.desc("_total"), F.asc(category)).limit(k)
        .select(category, F.inline("_line"))
        .select(year, category, amount)
    )


def place_activity(
    df: DataFrame, k: int | None = TOP_PLACES, *, place: str = "neighborhood",
    days: str = "processing_days", cost: str | None = "estimated_cost",
    round_to: int | None = None,
) -> DataFrame:
    """Rows, mean days and summed cost of the k busiest places, ties by name.

    Cost is summed in its own type; give it as a decimal to keep every cent.
    """
    mean = F.avg(days)
    aggs = [F.count("*").alias("total_permits"),
            (mean if round_to is None else F.round(mean, round_to)).alias("avg_processing_days")]
    if cost:
        aggs.append(F.sum(cost).alias("total_estimated_cost"))
    found = df.filter(F.col(place).isNotNull()).groupBy(place).agg(*aggs)
    return found if k is None else found.orderBy(F.desc("total_permits"), F.asc(place)).limit(k)


def places_ranked(
    df: DataFrame, *, place: str = "neighborhood", year: str = "issued_year",
    years: tuple[int, int] = RANKING_YEARS,
) -> DataFrame:
    """Rows per place and year, the place's rank in that year, and the change since the last
    year in which the place appears (which need not be the year before)."""
    counts = (
        df.filter(F.col(place).isNotNull() & F.col(year).between(*years))
        .groupBy(place, year).agg(F.count("*").alias("permit_count"))
    )
    # a place has at most one row per year here, so these windows stay small at any scale
    series = W.partitionBy(place).orderBy(year)
    changed = counts.withColumn(
        "yoy_change", F.col("permit_count") - F.lag("permit_count").over(series))
    return rank_within(changed, [year], "permit_count", "rank_in_year") \
        .select(place, year, "permit_count", "rank_in_year", "yoy_change")


def category_counts(
    df: DataFrame, category: str, k: int | None = None, *, name: str = "permit_count"
) -> DataFrame:
    """Rows per non-blank category, largest first, optionally only the k largest."""
    counts = value_counts(df.filter(F.trim(category) != ""), category, name)
    return counts if k is None else counts.orderBy(F.desc(name), F.asc(category)).limit(k)


def top_share(
    df: DataFrame, k: int, *, place: str = "neighborhood", name: str = "permit_count"
) -> DataFrame:
    """The k busiest places with their part of all rows."""
    return with_share(value_counts(df, place, name), name) \
        .orderBy(F.desc(name), F.asc(place)).limit(k)


def peak_years(
    counts: DataFrame, *, year: str = "issued_year", category: str = "permit_type",
    amount: str = "permit_count",
) -> DataFrame:
    """Each category's largest year (the earliest of equals) and the deepest fall from one
    listed year to the next; NULL where there is only one year."""
    series = W.partitionBy(category).orderBy(year)
    best = F.max(F.struct(F.col(amount), (-F.col(year)).alias("y")))
    return (
        counts.withColumn("_change", F.col(amount) - F.lag(amount).over(series))
        .groupBy(category)
        .agg(best.alias("_best"), F.min("_change").alias("largest_drop"))
        .select(category, (-F.col("_best.y")).alias("peak_year"),
                F.col(f"_best.{amount}").alias("peak_count"), "largest_drop")
    )
