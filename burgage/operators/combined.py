"""Reports over two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DAYS_RANGE, MIN_PAIRS, TREND_YEARS


def income_vs_wait(
    permits: DataFrame, tracts: DataFrame, *, place: str = "neighborhood",
    days: str = "processing_days", permit_key: str = "zipcode", tract_key: str = "tract",
    income: str = "median_income", rent: str = "median_rent",
    days_range: tuple[int, int] = DAYS_RANGE, min_pairs: int = MIN_PAIRS,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Mean wait per place beside the mean income and rent of the tracts its permits match.

    The figures are those of the joined pairs: a permit that matches three tracts counts three
    times. Pairs are not built. Both sides are aggregated on the join key and a group of n
    permits with a group of m tracts stands for n * m pairs, with all sums weighted accordingly.
    Tracts without a positive income do not take part. Permits without a tract are left out, or,
    with `keep_unmatched`, count once with no income.
    """
    # not NULL-safe on purpose: a NULL key matches nothing, but an unmatched permit may be kept
    waits = (
        permits.filter(F.col(place).isNotNull() & F.col(days).between(*days_range))
        .groupBy(place, F.col(permit_key).alias("_key"))
        .agg(F.count("*").alias("_n"), F.sum(days).alias("_days"))
    )
    areas = (
        tracts.filter((F.col(income) > 0) & F.col(tract_key).isNotNull())
        .groupBy(F.col(tract_key).alias("_tract"))
        .agg(F.count("*").alias("_m"), F.sum(income).alias("_income"),
             F.sum(rent).alias("_rent"), F.count(rent).alias("_rents"))
    )
    joined = waits.join(areas, F.col("_key") == F.col("_tract"),
                        "left" if keep_unmatched else "inner")
    times = F.coalesce(F.col("_m"), F.lit(1))
    pairs = F.sum(F.col("_n") * times)
    return (
        joined.groupBy(place).agg(
            F.try_divide(F.sum(F.col("_days") * times).cast("double"), pairs)
            .alias("avg_wait_days"),
            pairs.alias("permit_count"),
            F.round(F.try_divide(F.sum(F.col("_n") * F.col("_income")).cast("double"),
                                 F.sum(F.col("_n") * F.col("_m"))), 0).alias("avg_median_income"),
            F.round(F.try_divide(F.sum(F.col("_n") * F.col("_rent")).cast("double"),
                                 F.sum(F.col("_n") * F.col("_rents"))), 0)
            .alias("avg_median_rent"))
        .filter(F.col("permit_count") >= min_pairs)
    )


def income_wait_scatter(report: DataFrame, *, place: str = "neighborhood") -> DataFrame:
    """The report's columns under their plotting roles; points without an income have no x."""
    return report.select(
        F.col(place).alias("label"), F.col("avg_median_income").alias("x"),
        F.col("avg_wait_days").alias("y"), F.col("permit_count").alias("size"),
        F.col("avg_median_rent").alias("colour"))


def yearly_totals(
    counts: DataFrame, *, year: str = "issued_year", amount: str = "permit_count",
) -> DataFrame:
    """Counts per (year, category) summed to years; NULL categories count, NULL years do not."""
    return counts.filter(F.col(year).isNotNull()).groupBy(F.col(year).alias("year")) \
        .agg(F.coalesce(F.sum(amount), F.lit(0)).alias("total_permits"))


def yearly_index(
    series: DataFrame, *, date: str = "observation_date", value: str = "hpi_value",
) -> DataFrame:
    """Mean of the values that a year has."""
    return series.filter(F.col(date).isNotNull()) \
        .groupBy(F.year(date).cast("bigint").alias("year")).agg(F.avg(value).alias("hpi"))


def permits_vs_index(
    counts: DataFrame, series: DataFrame, *, year: str = "issued_year",
    amount: str = "permit_count", date: str = "observation_date", value: str = "hpi_value",
    years: tuple[int, int] = TREND_YEARS,
) -> DataFrame:
    """Yearly totals beside the yearly mean index, for years that both have."""
    within = F.col("year").between(*years)
    return yearly_totals(counts, year=year, amount=amount).filter(within).join(
        yearly_index(series, date=date, value=value).filter(within), "year")
