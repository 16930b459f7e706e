"""CSV files that keep arriving, cleaned and appended to tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.cleaning import PERMIT_ROLES, clean_permits, undated_permits
from ..schemas import BUILDING_PERMITS, as_strings
from ..sources import Typed, null_tokens, type_columns


def permits_stream(
    spark: SparkSession, folder: str, schema: T.StructType = BUILDING_PERMITS,
    *, multiline: bool = True, files_per_batch: int | None = None,
) -> Typed:
    """Permits from files as they land in a folder: converted rows, and raw rows that do not convert.

    Descriptions hold line breaks inside quotes, so a record may go over several lines unless
    `multiline` is off; such a file is read by one task, and files are the unit of parallel work.
    """
    reader = (
        spark.readStream.schema(as_strings(schema))
        .option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
        .option("quote", '"').option("escape", '"').option("multiLine", multiline)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return type_columns(null_tokens(reader.csv(folder)), schema)


def clean_permits_stream(
    spark: SparkSession, folder: str, roles: Mapping[str, str] = PERMIT_ROLES, *,
    multiline: bool = True, files_per_batch: int | None = None, **options,
) -> tuple[Typed, DataFrame]:
    """Cleaned permits with the raw rejects beside them, and the permits without a legible issue
    date, all as streams; `options` go to `clean_permits`."""
    typed = permits_stream(spark, folder, multiline=multiline, files_per_batch=files_per_batch)
    undated = undated_permits(typed.good, roles, formats=options.get("formats"))
    return Typed(clean_permits(typed.good, roles, **options), typed.rejects), undated


def store_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has landed since the last run to a parquet table, then stop.

    The file sink's log makes each file count once, however often a run is broken off.
    """
    return (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def store_permits(
    spark: SparkSession, folder: str, out: str, checkpoint: str, **options,
) -> dict[str, StreamingQuery]:
    """Append what has landed to the tables `permits`, `rejects` and `undated` below `out`.

    Three queries, each with its own checkpoint, so nothing that landed is lost without a trace.
    """
    typed, undated = clean_permits_stream(spark, folder, **options)
    parts = {"permits": typed.good, "rejects": typed.rejects, "undated": undated}
    return {name: store_stream(df, f"{out.rstrip('/')}/{name}", f"{checkpoint.rstrip('/')}/{name}")
            for name, df in parts.items()}
