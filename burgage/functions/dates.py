"""Date expressions that give NULL, never an error, on bad input."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _column


# Month-first dates, and text with neither slash nor dash: a bare number such as 20180105 would
# otherwise be cast to a far-off year. The groups are empty for the latter, which casts to NULL.
_NOT_ISO = r"^(?:\s*+(\d{1,2})/(\d{1,2})/(\d{4})(?!\d)|[^-/]*+$)"


def parse_timestamp(c: Column | str, formats: Sequence[str] | None = None) -> Column:
    """Text to TIMESTAMP_NTZ, or NULL.

    Without `formats` two families are read: ISO (`2018-01-05`, `2018-1-5 10:30:00`,
    `2018-01-05T10:30:00.5`) and month-first (`1/5/2018`, `01/05/2018 10:30:00`). Month-first
    text is turned into ISO and then cast: a cast that fails yields NULL without raising an
    exception, which a format parser does for every bad row. The input occurs only once in the
    expression, so it is not computed again and again when Spark merges projections.
    """
    c = _column(c)
    if formats is not None:
        tries = [F.try_to_timestamp(c, F.lit(f)) for f in formats]
        return F.coalesce(*tries).cast("timestamp_ntz")
    return F.regexp_replace(c, _NOT_ISO, "$3-$1-$2").try_cast("timestamp_ntz")


def parse_date(c: Column | str, formats: Sequence[str] | None = None) -> Column:
    """Text to DATE, or NULL."""
    return parse_timestamp(c, formats).cast("date")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Midnights crossed from `start` to `end`, as a bigint; negative when `end` comes first."""
    return F.datediff(_column(end), _column(start)).cast("bigint")


def within_years(c: Column | str, years: tuple[int, int]) -> Column:
    """Whether a date lies in the years, both included.

    Unlike a condition on `year(c)`, this compares the column itself, so a parquet scan can skip
    what lies outside.
    """
    c = _column(c)
    first, last = years
    return (c >= F.lit(datetime.date(first, 1, 1))) & (c < F.lit(datetime.date(last + 1, 1, 1)))


def quarter_label(c: Column | str) -> Column:
    """`2018 Q3`."""
    c = _column(c)
    return F.concat(F.year(c).cast("string"), F.lit(" Q"), F.quarter(c).cast("string"))
