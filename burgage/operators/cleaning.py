"""Raw tables to cleaned tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import days_between, initcap_words, null_if, parse_date, parse_timestamp, percent_of
from ..schemas import MISSING_SENTINEL

# role -> raw column; a role that is absent is left out of the result
PERMIT_ROLES = {
    "permit_number": "permit_number",
    "permit_type": "permit_type_definition",
    "filed_date": "filed_date",
    "issued_date": "issued_date",
    "completed_date": "completed_date",
    "existing_use": "existing_use",
    "proposed_use": "proposed_use",
    "estimated_cost": "estimated_cost",
    "existing_units": "existing_units",
    "proposed_units": "proposed_units",
    "neighborhood": "neighborhoods_analysis_boundaries",
    "zipcode": "zipcode",
    "supervisor_district": "supervisor_district",
}

# the narrower table: no completion date, units or district, and time stamps named as such
NARROW_PERMIT_ROLES = {
    k: v for k, v in PERMIT_ROLES.items()
    if k not in ("completed_date", "existing_units", "proposed_units", "supervisor_district")
}

_DATES = ("filed_date", "issued_date", "completed_date")


def clean_permits(
    raw: DataFrame,
    roles: Mapping[str, str] = PERMIT_ROLES,
    *,
    days_range: tuple[int, int] | None = None,
    initcap_mode: str = "punctuation",
    date_suffix: str = "",
    formats: Sequence[str] | None = None,
) -> DataFrame:
    """Permits with parsed dates, issue year, capitalised type and days from filing to issue.

    Dates are read as ISO or month-first, or by `formats` if given. Rows whose issue date does
    not parse are dropped, see `undated_permits` for them. Without `days_range` rows keep missing,
    negative and very large day counts; with it (bounds included) such rows are dropped as well.
    Stateless, so it also applies to a stream.
    """
    def dated(role: str) -> str:
        return role + date_suffix

    # Each date is parsed once. A filter on a parsed date would be pushed to the scan with a copy
    # of the whole expression, but not through a generator.
    parsed = raw.select(
        F.inline(F.array(F.struct(*[
            parse_timestamp(roles[r], formats).alias(dated(r)) for r in _DATES if r in roles]))),
        *[(initcap_words(src, initcap_mode) if r == "permit_type" else F.col(f"`{src}`")).alias(r)
          for r, src in roles.items() if r not in _DATES],
    ).filter(F.col(dated("issued_date")).isNotNull())

    days = days_between(dated("filed_date"), dated("issued_date"))
    if days_range is not None:
        parsed = parsed.filter(days.between(*days_range))

    out: list[Column] = []
    for role in roles:
        if role not in _DATES:
            out.append(F.col(role))
            continue
        out.append(F.col(dated(role)))
        if role == "issued_date":
            out.append(F.year(dated(role)).cast("bigint").alias("issued_year"))
    return parsed.select(*out, days.alias("processing_days"))


def undated_permits(
    raw: DataFrame, roles: Mapping[str, str] = PERMIT_ROLES, *,
    formats: Sequence[str] | None = None,
) -> DataFrame:
    """The raw rows that `clean_permits` drops because their issue date is missing or illegible."""
    return raw.filter(parse_timestamp(roles["issued_date"], formats).isNull())


def clean_land_use(
    raw: DataFrame,
    *,
    landuse: str = "landuse",
    restype: str = "restype",
    keep: tuple[str, ...] = ("blklot", "block", "lot", "street", "bldgsqft", "yrbuilt", "units",
                             "the_geom"),
) -> DataFrame:
    """Parcels with a land use; the residential type trimmed, geometry kept as text."""
    return raw.filter(F.col(landuse).isNotNull()).select(
        *keep, F.col(landuse).alias("landuse"), F.trim(restype).alias("restype"))


def clean_price_index(
    raw: DataFrame, *, date: str = "observation_date", value: str = "value",
    formats: Sequence[str] | None = None,
) -> DataFrame:
    """Dated index values; rows whose date does not parse are dropped, see `undated_index`.

    Sort where it is written.
    """
    return raw.select(parse_date(date, formats).alias("observation_date"),
                      F.col(value).alias("hpi_value")) \
        .filter(F.col("observation_date").isNotNull())


def undated_index(
    raw: DataFrame, *, date: str = "observation_date", formats: Sequence[str] | None = None
) -> DataFrame:
    """The raw rows that `clean_price_index` drops."""
    return raw.filter(parse_date(date, formats).isNull())


def clean_census(
    raw: DataFrame,
    *,
    name: str = "name",
    rent: str = "median_rent",
    income: str = "median_income",
    total: str = "pop_total",
    part: str = "pop_white",
    keep: tuple[str, ...] = ("geoid", "state", "county", "tract"),
    sentinel: int | float = MISSING_SENTINEL,
) -> DataFrame:
    """Tract statistics with the missing-value sentinel as NULL and a share in percent."""
    return raw.select(
        F.col(name).alias("tract_name"), *keep,
        null_if(rent, sentinel).alias("median_rent"),
        null_if(income, sentinel).alias("median_income"),
        F.col(total).alias("pop_total"), F.col(part).alias("pop_white"),
        percent_of(part, total).alias("pct_white"))


def with_geoid(df: DataFrame, parts: tuple[str, ...] = ("state", "county", "tract")) -> DataFrame:
    """Add the joined-up key; NULL where any part is NULL."""
    return df.withColumn("geoid", F.concat(*parts))
