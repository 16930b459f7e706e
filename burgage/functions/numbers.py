"""Number expressions: tolerant casts, sentinels, guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _column


def nan_to_null(c: Column | str) -> Column:
    c = _column(c)
    return F.when(~F.isnan(c), c)


def number_or_null(c: Column | str) -> Column:
    """Double, or NULL for anything that is not a number (NaN included)."""
    return nan_to_null(_column(c).try_cast("double"))


def whole_number(c: Column | str) -> Column:
    """Text to bigint; `12.0` and `1.2e1` are 12 and halves round away from zero."""
    return F.round(_column(c).try_cast("decimal(38,10)"), 0).try_cast("bigint")


def null_if(c: Column | str, *sentinels) -> Column:
    """NULL where the value is one of the sentinels."""
    c = _column(c)
    return F.when(~c.isin(*sentinels), c)


def percent_of(part: Column | str, whole: Column | str, digits: int = 1) -> Column:
    """part / whole in percent, rounded; NULL unless whole > 0."""
    part, whole = _column(part), _column(whole)
    return F.when(whole > 0, F.round(part.cast("double") / whole.cast("double") * 100, digits))


def thousands(c: Column | str, digits: int = 0, prefix: str = "") -> Column:
    """`1,234,567`, with an optional prefix such as `$`."""
    return F.concat(F.lit(prefix), F.format_number(_column(c), digits))
