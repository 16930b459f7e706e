"""The whole course from landed files to exports, on the four public record sets.

    sources = load_sources(spark, {"permits": ..., "land_use": ..., "price_index": ..., "census": ...})
    sources["census"] = load_census_responses(spark, ...)   # where the census landed as JSON
    clean = clean_sources(sources)
    stored = store(spark, clean, folder)        # optional, but reports then read parquet by year
    views = reports(stored)
    export_all(views, out_folder, orders=orders())
    export_all(samples(stored), out_folder)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import activity, cleaning, combined, flows, ranking, regions, series, timing
from ..schemas import (BUILDING_PERMITS, CENSUS_ACS, CENSUS_VARIABLES, DAYS_RANGE,
                       HOUSE_PRICE_INDEX, LAND_USE, SAMPLE_ROWS, TOP_TIMING_TYPES)
from ..sources import (Typed, decode_json_table, read_csv, read_csv_split, read_json_tables, register_view,
                       rejected_responses, type_columns, write_table)

LAYOUTS = {
    "permits": BUILDING_PERMITS,
    "land_use": LAND_USE,
    "price_index": HOUSE_PRICE_INDEX,
    "census": CENSUS_ACS,
}


def load_sources(
    spark: SparkSession, paths: Mapping[str, str], *, multiline: tuple[str, ...] = ("permits",)
) -> dict[str, Typed]:
    """Landed CSV files, converted, with the rejects of each source beside the good rows.

    Files of the sources in `multiline` may have line breaks inside quotes. They are read by ranges, as
    others are, after one pass at once that learns how the ranges begin.
    """
    return {
        name: type_columns(
            read_csv_split(spark, path, LAYOUTS[name]) if name in multiline
            else read_csv(spark, path, LAYOUTS[name]), LAYOUTS[name])
        for name, path in paths.items()
    }


class Responses(NamedTuple):
    """Rows that converted, raw rows that did not, and responses that were no table, with paths."""

    good: DataFrame
    rejects: DataFrame
    responses: DataFrame


def load_census_responses(spark: SparkSession, path: str | Sequence[str]) -> Responses:
    """The census service's responses as they landed, one JSON table in each file."""
    landed = read_json_tables(spark, path)
    fields = {**CENSUS_VARIABLES, "state": "state", "county": "county", "tract": "tract"}
    rows = cleaning.with_geoid(decode_json_table(landed, fields))
    return Responses(*type_columns(rows.select(*CENSUS_ACS.fieldNames()), CENSUS_ACS),
                     rejected_responses(landed))


def clean_sources(
    sources: Mapping[str, Typed | Responses], *, days_range: tuple[int, int] | None = None,
    formats: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Cleaned tables under their usual names; `formats` are those of dates, if not the usual."""
    return {
        "permits_clean": cleaning.clean_permits(sources["permits"].good, days_range=days_range,
                                                formats=formats),
        "land_use_clean": cleaning.clean_land_use(sources["land_use"].good),
        "hpi_clean": cleaning.clean_price_index(sources["price_index"].good, formats=formats),
        "census_clean": cleaning.clean_census(sources["census"].good),
    }


def undated(
    sources: Mapping[str, Typed | Responses], *, formats: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """The raw rows that cleaning drops because their date is missing or illegible."""
    return {"permits": cleaning.undated_permits(sources["permits"].good, formats=formats),
            "price_index": cleaning.undated_index(sources["price_index"].good, formats=formats)}


def store(
    spark: SparkSession, clean: Mapping[str, DataFrame], folder: str
) -> dict[str, DataFrame]:
    """Write the cleaned tables as parquet, permits by issue year, and read them back."""
    stored = {}
    for name, df in clean.items():
        path = f"{folder.rstrip('/')}/{name}"
        write_table(df, path, partition_by=["issued_year"] if name == "permits_clean" else ())
        stored[name] = spark.read.schema(df.schema).parquet(path)
    return stored


def orders() -> dict[str, list[str | Column]]:
    """The order of each report, for display and for exports."""
    return {
        "permits_trend": ["issued_year", "permit_type"],
        "trend_top_types": ["issued_year", "permit_type"],
        "neighborhood_activity": [F.desc("total_permits"), "neighborhood"],
        "change_of_use": [F.desc("flow_count"), "existing_use", "proposed_use"],
        "sankey_nodes": ["node_id"],
        "sankey_links": [F.desc("value"), "source_id", "target_id"],
        "housing_types": [F.desc("parcel_count"), "restype"],
        "hpi_clean": ["observation_date"],
        "hpi_series": ["observation_date"],
        "neighborhood_income_vs_wait": [F.desc("avg_wait_days"), "neighborhood"],
        "processing_stats": [F.desc("avg_days"), "permit_type"],
        "processing_time_box": ["permit_type"],
        "neighborhood_ranked": [F.desc("issued_year"), "rank_in_year", "neighborhood"],
        "permits_vs_hpi": ["year"],
        "county_stats": ["county"],
        "county_markers": ["county"],
    }


def reports(clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The views over the cleaned tables, each in its order."""
    permits, census = clean["permits_clean"], clean["census_clean"]
    timely = permits.filter(F.col("processing_days").between(*DAYS_RANGE))
    trend = activity.trend(permits)
    changes = flows.change_of_use(permits)
    by_county, bounds = regions.county_stats_and_bounds(census)
    views = {
        "quality_summary": activity.quality_summary(permits),
        "permits_trend": trend,
        "trend_top_types": activity.trend_top_types(trend),
        "processing_time": timing.processing_time(permits),
        "processing_time_box": timing.box_summary(
            timing.processing_time(permits), "processing_days", "permit_type",
            k=TOP_TIMING_TYPES, bounded_values=True),
        "neighborhood_activity": activity.place_activity(permits),
        "change_of_use": changes,
        "sankey_nodes": flows.sankey_nodes(changes),
        "sankey_links": flows.sankey_links(changes),
        "housing_types": activity.category_counts(
            clean["land_use_clean"], "restype", name="parcel_count"),
        "hpi_clean": clean["hpi_clean"],
        "hpi_series": series.index_series(clean["hpi_clean"]),
        "permits_vs_hpi": combined.permits_vs_index(trend, clean["hpi_clean"]),
        "census_clean": census,
        "county_stats": by_county,
        "county_markers": regions.county_markers(by_county, bounds),
        "neighborhood_income_vs_wait": combined.income_vs_wait(permits, census),
        "processing_stats": timing.processing_stats(timely),
        "neighborhood_ranked": activity.places_ranked(timely),
    }
    order = orders()
    return {name: df.orderBy(*order[name]) if name in order else df for name, df in views.items()}


def samples(clean: Mapping[str, DataFrame], n: int = SAMPLE_ROWS) -> dict[str, DataFrame]:
    """What is exported in place of the full day counts: n rows of them."""
    timely = clean["permits_clean"].filter(F.col("processing_days").between(*DAYS_RANGE))
    rows = timely.select("permit_number", "permit_type", "processing_days")
    return {"processing_time_sample": ranking.sample_rows(rows, n, rows.columns)
            .select("permit_type", "processing_days")}


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Make every table or report available to spark.sql under its name."""
    for name, df in frames.items():
        register_view(df, name)
