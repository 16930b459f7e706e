"""Column expressions. All are built from Spark's own functions; none is a Python UDF."""

from .dates import days_between, parse_date, parse_timestamp, quarter_label, within_years
from .numbers import nan_to_null, null_if, number_or_null, percent_of, thousands, whole_number
from .text import clean_header, initcap_words, label_for, zero_fill

__all__ = [
    "clean_header", "days_between", "initcap_words", "label_for", "nan_to_null", "null_if",
    "number_or_null", "parse_date", "parse_timestamp", "percent_of", "quarter_label",
    "thousands", "whole_number", "within_years", "zero_fill",
]
