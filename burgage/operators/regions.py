"""Regional statistics and map-ready markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import label_for, number_or_null, thousands, zero_fill
from ..schemas import (COUNTIES, MIN_RADIUS, PEOPLE_PER_RADIUS_UNIT, RENT_COLOUR_BOUNDS)
from ..session import written
from .quantiles import exact_quantiles, histogram, quantiles_of_counts


def find_column(df: DataFrame, keyword: str) -> str:
    """The first column whose name contains the keyword, in any case."""
    for name in df.columns:
        if keyword.lower() in name.lower():
            return name
    raise KeyError(f"no column name contains {keyword!r}")


def _figures(
    tracts: DataFrame, county: str, rent: str, income: str, population: str, tract: str,
    drop_missing_rent: bool, fill_code: bool,
) -> DataFrame:
    """Rows per (county, figure, value): all that the reports need, in one pass over the tracts."""
    read = number_or_null if fill_code else F.col
    code = zero_fill(county) if fill_code else F.col(county)
    counted = F.when(F.col(county if fill_code else tract).isNotNull(), F.lit(1.0))
    base = tracts.select(
        code.alias("county"), read(rent).cast("double").alias("rent"),
        read(income).cast("double").alias("income"),
        read(population).cast("double").alias("people"), counted.alias("tract"))
    if drop_missing_rent:
        base = base.filter(F.col("rent").isNotNull())
    long = base.select("county", F.inline(F.array(
        F.struct(F.lit("row").alias("figure"), F.lit(1.0).alias("value")),
        *[F.struct(F.lit(f).alias("figure"), F.col(f).alias("value"))
          for f in ("rent", "income", "people", "tract")])))
    return histogram(long, "value", ["county", "figure"], "n")


def _stats(figures: DataFrame, whole: bool) -> DataFrame:
    known = figures.filter(F.col("county").isNotNull())

    def total(figure: str, amount: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("figure") == figure, amount)), F.lit(0))

    people = total("people", F.col("value") * F.col("n"))
    totals = known.groupBy("county").agg(
        (people.cast("bigint") if whole else people).alias("population"),
        total("tract", F.col("n")).alias("tract_count"))
    middle = quantiles_of_counts(known.filter(F.col("figure").isin("rent", "income")), "value", "n",
                                 [0.5], ["county", "figure"], ["_median"])
    medians = middle.groupBy("county").agg(*[
        F.max(F.when(F.col("figure") == f, F.col("_median"))).alias(f"median_{f}")
        for f in ("rent", "income")])
    return totals.join(medians, "county", "left").select(
        "county", "median_rent", "median_income", "population", "tract_count")


def _is_whole(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.LongType, T.IntegerType))


def county_stats(
    tracts: DataFrame, *, county: str = "county", rent: str = "median_rent",
    income: str = "median_income", population: str = "pop_total", tract: str = "tract",
    drop_missing_rent: bool = True, fill_code: bool = False,
) -> DataFrame:
    """Median rent and income of a county's tracts, its population and number of tracts.

    With `drop_missing_rent` tracts without a rent take no part at all. With `fill_code` county
    codes are zero-filled to three digits and the figures are read tolerantly, so text that is
    no number counts as missing; tracts are then counted by their county code.
    """
    return _stats(_figures(tracts, county, rent, income, population, tract, drop_missing_rent, fill_code),
                  _is_whole(tracts, population))


def county_stats_and_bounds(
    tracts: DataFrame, low: float = 0.1, high: float = 0.9, *, county: str = "county",
    rent: str = "median_rent", income: str = "median_income", population: str = "pop_total",
    tract: str = "tract",
) -> tuple[DataFrame, DataFrame]:
    """`county_stats` without tracts that lack a rent, and `colour_bounds` over all counties.

    The tracts are read once, at once: their counts by county, figure and value are written to the
    shared folder, and totals, medians and bounds all come from there.
    """
    figures = written(_figures(tracts, county, rent, income, population, tract, True, False), "figures")
    rents = figures.filter(F.col("figure") == "rent").groupBy("value").agg(F.sum("n").alias("n"))
    return _stats(figures, _is_whole(tracts, population)), quantiles_of_counts(
        rents, "value", "n", [low, high], names=["vmin", "vmax"])


def colour_bounds(
    tracts: DataFrame, *, rent: str = "median_rent", low: float = 0.1, high: float = 0.9
) -> DataFrame:
    """One row: the low and high quantile of rent over all tracts."""
    return exact_quantiles(tracts, rent, [low, high], names=["vmin", "vmax"])


def county_table(spark: SparkSession, digits: int | None = None) -> DataFrame:
    """The nine counties with their centre points, optionally rounded."""
    def shown(x: float) -> float:
        return x if digits is None else round(x, digits)

    rows = ", ".join(f"('{code}', {shown(lat)}D, {shown(lon)}D)" for code, _, lat, lon in COUNTIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(county, lat, lon)")


def county_markers(
    stats: DataFrame, bounds: DataFrame | None = None, *, digits: int | None = None
) -> DataFrame:
    """Statistics of known counties with position, radius, colour range and label texts.

    Counties outside the table are dropped. The colour range is the one row of `bounds`, or the
    fixed range where none is given. A county without a population has the least radius.
    """
    names = {code: name for code, name, _, _ in COUNTIES}
    # nine rows
    placed = stats.join(F.broadcast(county_table(stats.sparkSession, digits)), "county")
    if bounds is None:
        low, high = map(F.lit, RENT_COLOUR_BOUNDS)
    else:
        span = bounds.agg(F.max(F.struct("vmin", "vmax"))).scalar()
        low, high = span.getField("vmin"), span.getField("vmax")
    return placed.select(
        "county", label_for("county", names).alias("name"), "lat", "lon",
        F.greatest(F.lit(MIN_RADIUS), F.col("population").cast("double") / PEOPLE_PER_RADIUS_UNIT)
        .alias("radius"),
        "median_rent", "median_income", "population", "tract_count",
        low.alias("vmin"), high.alias("vmax"),
        thousands("median_rent", prefix="$").alias("rent_text"),
        thousands("median_income", prefix="$").alias("income_text"),
        thousands("population").alias("population_text"))


def attach_areas(areas: DataFrame, tracts: DataFrame, key: str = "geoid") -> DataFrame:
    """Tract statistics beside their boundary rows, by key; areas without statistics stay."""
    return areas.join(tracts, key, "left")
