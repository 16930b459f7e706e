"""JSON responses that hold a table as an array of arrays, header row first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json_tables(
    spark: SparkSession, path: str | Sequence[str], *, recursive: bool = False
) -> DataFrame:
    """One row per landed response file, its text in `value` and where it lies in `path`.

    A response is one JSON value, so a file is the unit of parallel work here. All responses
    under `path` (a folder, a glob or a list) are appended, with `recursive` those of folders in it.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    return reader.text(path if isinstance(path, str) else list(path), wholetext=True) \
        .select("value", F.col("_metadata.file_path").alias("path"))


def decode_json_table(
    responses: DataFrame,
    columns: Mapping[str, str] | Sequence[str],
    *,
    text: str = "value",
) -> DataFrame:
    """Rows of all responses as text columns.

    `columns` names the wanted header fields; given as a mapping it renames them. Values are
    found by each response's own header, so responses may order their fields differently. A
    field that a response lacks is NULL; a response that is not such a table gives no rows, see
    `rejected_responses`.
    """
    wanted = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    grid = F.from_json(F.col(text), "array<array<string>>")
    rows = (
        responses.select(grid.alias("grid"))
        .select(F.try_element_at("grid", F.lit(1)).alias("header"),
                F.explode(F.slice("grid", F.lit(2), F.greatest(F.size("grid") - 1, F.lit(0))))
                .alias("row"))
    )

    def field(name: str) -> Column:
        # array_position is 0 for a missing name; index 0 is not legal, so make it NULL
        place = F.nullif(F.array_position("header", F.lit(name)), F.lit(0)).cast("int")
        return F.try_element_at("row", place)

    return rows.select([field(name).alias(alias) for name, alias in wanted.items()])


def rejected_responses(responses: DataFrame, *, text: str = "value") -> DataFrame:
    """The responses that are no table with a header row."""
    header = F.try_element_at(F.from_json(F.col(text), "array<array<string>>"), F.lit(1))
    return responses.filter(header.isNull() | (F.size(header) == 0))


def append_all(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, columns matched by name; a column that a part lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
