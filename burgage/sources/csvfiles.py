"""Tolerant CSV loading.

Three lazy steps, each usable alone: read every field as text by position, turn null tokens into
NULL, then convert by layout and set apart the rows that do not convert. What counts as a bad row
is decided by the conversion and not by the reader's mode, so column pruning cannot change it.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean_header, nan_to_null, parse_timestamp, whole_number
from ..schemas import NULL_TOKENS, as_strings


class Typed(NamedTuple):
    """Rows that converted, and the raw rows that did not with the names of the bad columns."""

    good: DataFrame
    rejects: DataFrame


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    *,
    header: bool = True,
    multiline: bool = False,
    tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """Read CSV files as text columns named by `schema`, by position.

    Short rows are filled with NULL and surplus fields are ignored. `multiline` accepts line
    breaks inside quotes; such a file cannot be split over tasks, so it is off unless asked for.
    """
    path = path if isinstance(path, str) else list(path)
    raw = (
        spark.read.schema(as_strings(schema))
        .option("header", header)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    return null_tokens(raw, tokens)


def read_csv_inferred(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    multiline: bool = False,
    clean_names: bool = False,
) -> DataFrame:
    """Read CSV files by header with inferred types. Inference costs one more pass over the data."""
    path = path if isinstance(path, str) else list(path)
    df = (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("multiLine", multiline)
        .option("escape", '"')
        .csv(path)
    )
    return df.toDF(*[clean_header(c) for c in df.columns]) if clean_names else df


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """NULL for every string value that is one of `tokens`; other columns pass through."""
    return df.select([
        F.when(~F.col(f"`{f.name}`").isin(*tokens), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def _converted(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
        return whole_number(c).try_cast(kind)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return parse_timestamp(c).cast(kind)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(c.try_cast(kind))
    return c.try_cast(kind)


def type_columns(raw: DataFrame, schema: T.StructType) -> Typed:
    """Convert text columns by `schema`; a row with a value that does not convert is a reject."""
    names = [f.name for f in schema.fields]
    converted = {f.name: _converted(f.name, f.dataType) for f in schema.fields
                 if not isinstance(f.dataType, T.StringType)}
    bad = {n: F.col(f"`{n}`").isNotNull() & c.isNull() for n, c in converted.items()}
    any_bad = F.lit(False)
    for flag in bad.values():
        any_bad = any_bad | flag
    good = raw.filter(~any_bad).select([converted.get(n, F.col(f"`{n}`")).alias(n) for n in names])
    named = [F.when(flag, F.lit(n)) for n, flag in bad.items()]
    bad_columns = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    return Typed(good, raw.filter(any_bad).withColumn("bad_columns", bad_columns))


def list_landed(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Path, size and time of each landed file; the contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "modificationTime")
