"""What a table looks like."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nan_to_null, parse_timestamp


def profile(tables: Mapping[str, DataFrame], *, partitions: bool = False) -> DataFrame:
    """Rows and columns of each table and, on request, in how many scan tasks its rows lie.

    Row counts read no column. The partition figure depends on the cluster and its settings.
    """
    def one(name: str, df: DataFrame) -> DataFrame:
        aggs = [F.count("*").alias("row_count")]
        if partitions:
            df = df.select(F.spark_partition_id().alias("_part")).groupBy("_part") \
                .agg(F.count("*").alias("_n"))
            aggs = [F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
                    F.count("*").alias("partition_count")]
        width = len(tables[name].columns)
        out = df.agg(*aggs)
        return out.select(F.lit(name).alias("table_name"), "row_count",
                          F.lit(width).cast("bigint").alias("column_count"),
                          *[c for c in out.columns if c == "partition_count"])

    return reduce(DataFrame.unionByName, [one(n, df) for n, df in tables.items()])


def describe_columns(df: DataFrame) -> DataFrame:
    """Position, name and type of each column."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


def by_position(df: DataFrame, *names: str) -> DataFrame:
    """Rename columns by position, the first `len(names)` of them."""
    return df.toDF(*names, *df.columns[len(names):])


# From the narrowest type to the widest; text takes everything.
LATTICE = ("boolean", "bigint", "double", "date", "timestamp_ntz", "string")
_TYPES = {"boolean": T.BooleanType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType(),
          "timestamp_ntz": T.TimestampNTZType(), "string": T.StringType()}


def _read_as(c: Column, kind: str) -> Column:
    """The text as a value of that type, NULL where it is none."""
    if kind == "boolean":
        return F.when(F.lower(c).isin("true", "false"), F.lower(c) == "true")
    if kind == "bigint":
        return F.when(c.rlike(r"^\s*[+-]?\d{1,19}\s*$"), c.try_cast("bigint"))
    if kind == "double":
        return nan_to_null(c.try_cast("double"))
    if kind in ("date", "timestamp_ntz"):
        time = parse_timestamp(c)
        return time if kind == "timestamp_ntz" else F.when(time == F.date_trunc("day", time), time)
    return c


def type_votes(text: DataFrame, heavy: int = 0, precision: float = 0.05) -> DataFrame:
    """What each column of a table of texts holds, from one pass and one row of results.

    (position, column_name, voted_type, rows, nulls, n_boolean, n_bigint, n_double, n_date,
    n_timestamp_ntz, least, most, longest, distinct_values): every value votes for the types that it can
    be read as, and the narrowest type of LATTICE that all values can be read as wins; a column without values
    is text. `least` and `most` are in the order of the voted type, as text; `distinct_values` is
    approximate. With `heavy`, `heavy_values` lists about that many frequent values with their counts.
    """
    names = text.columns
    kinds = LATTICE[:-1]
    aggs = [F.count("*").alias("rows")]
    for i, name in enumerate(names):
        c = F.col(f"`{name}`").cast("string")
        aggs += [F.count(c).alias(f"n_{i}"), F.max(F.length(c)).cast("bigint").alias(f"longest_{i}"),
                 F.approx_count_distinct(c, precision).alias(f"distinct_{i}")]
        if heavy:
            aggs.append(F.expr(f"approx_top_k(CAST(`{name}` AS STRING), {int(heavy)})").alias(f"heavy_{i}"))
        for kind in LATTICE:
            value = _read_as(c, kind)
            aggs += [F.count(value).alias(f"{kind}_{i}"), F.min(value).cast("string").alias(f"least_{kind}_{i}"),
                     F.max(value).cast("string").alias(f"most_{kind}_{i}")]

    def one(i: int, name: str) -> Column:
        full = F.col(f"n_{i}")
        voted, least, most = F.lit("string"), F.col(f"least_string_{i}"), F.col(f"most_string_{i}")
        for kind in reversed(kinds):
            wins = (full > 0) & (F.col(f"{kind}_{i}") == full)
            voted = F.when(wins, F.lit(kind)).otherwise(voted)
            least = F.when(wins, F.col(f"least_{kind}_{i}")).otherwise(least)
            most = F.when(wins, F.col(f"most_{kind}_{i}")).otherwise(most)
        return F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("column_name"), voted.alias("voted_type"),
            "rows", (F.col("rows") - full).alias("nulls"),
            *[F.col(f"{k}_{i}").alias(f"n_{k}") for k in kinds], least.alias("least"), most.alias("most"),
            F.col(f"longest_{i}").alias("longest"), F.col(f"distinct_{i}").alias("distinct_values"),
            *([F.col(f"heavy_{i}").alias("heavy_values")] if heavy else []))

    return text.agg(*aggs).select(F.inline(F.array(*[one(i, n) for i, n in enumerate(names)])))


def voted_layout(votes: DataFrame) -> T.StructType:
    """The layout that the votes elect; a row per column reaches the driver."""
    rows = votes.select("position", "column_name", "voted_type").orderBy("position").collect()
    return T.StructType([T.StructField(r["column_name"], _TYPES[r["voted_type"]]) for r in rows])
