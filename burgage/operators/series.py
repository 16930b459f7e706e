"""Time series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import quarter_label


def index_series(
    df: DataFrame, *, date: str = "observation_date", value: str = "hpi_value"
) -> DataFrame:
    """Dated values with their quarter as a label, e.g. `2018 Q3`, in date order."""
    return df.select(F.to_date(date).alias("observation_date"), F.col(value).alias("hpi_value")) \
        .withColumn("quarter", quarter_label("observation_date")).orderBy("observation_date")
