"""The driver's tables in the roles of permits, parcels, price index and census tracts.

Every binding reads its tables whole. Where a CASE on a key spoils a value (a date that does not
parse, a blank type, a sentinel), the row itself stays: the tables hold no NULLs of their own, and
the cleaning steps need something to clean. Joins are limited to the tables a report needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import days_between, within_years
from ..schemas import MISSING_SENTINEL

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in TABLES}


def lines(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Line items, optionally only those shipped in the years that a report is about."""
    df = table(spark, sf_dir, "lineitem")
    return df if years is None else df.filter(within_years("l_shipdate", years))


def issued(
    spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None
) -> DataFrame:
    """Permits with issue year and type only: one table, no join."""
    return lines(spark, sf_dir, years).select(
        F.col("l_returnflag").alias("permit_type"),
        F.year("l_shipdate").cast("bigint").alias("issued_year"))


def issued_by_brand(
    spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None
) -> DataFrame:
    """Permits whose type and use come from the part."""
    parts = table(spark, sf_dir, "part")
    return lines(spark, sf_dir, years).join(parts, F.col("l_partkey") == parts.p_partkey).select(
        F.col("p_brand").alias("permit_type"), F.col("p_brand").alias("existing_use"),
        F.year("l_shipdate").cast("bigint").alias("issued_year"))


def _timed(df: DataFrame, *more: Column) -> DataFrame:
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        F.col("o_orderpriority").alias("permit_type"),
        F.year("l_shipdate").cast("bigint").alias("issued_year"),
        days_between("o_orderdate", "l_shipdate").alias("processing_days"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("estimated_cost"), *more)


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permits with filing and issue date."""
    orders = table(spark, sf_dir, "orders")
    return _timed(lines(spark, sf_dir).join(orders, F.col("l_orderkey") == orders.o_orderkey))


def _orders_of(spark: SparkSession, sf_dir: str, nations: DataFrame) -> DataFrame:
    """Orders with customer and nation. Joined before the lines, of which an order has several,
    so that the lines are shuffled once, by order, and not again by customer."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    return orders.join(
        customers.join(nations, customers.c_nationkey == nations.n_nationkey),
        orders.o_custkey == customers.c_custkey)


def placed(
    spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None
) -> DataFrame:
    """Timed permits with a place (the customer's nation) and an area code to match tracts by."""
    orders = _orders_of(spark, sf_dir, table(spark, sf_dir, "nation"))
    return _timed(
        lines(spark, sf_dir, years).join(orders, F.col("l_orderkey") == orders.o_orderkey),
        F.col("n_name").alias("neighborhood"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("zipcode"))


def permits_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw permits: dates as text in two notations, some missing and some no dates at all."""
    orders = table(spark, sf_dir, "orders")
    month_first = F.date_format("l_shipdate", "MM/dd/yyyy")
    return lines(spark, sf_dir).join(orders, F.col("l_orderkey") == orders.o_orderkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("permit_number"),
        F.col("o_orderpriority").alias("permit_type_definition"),
        F.when(F.col("l_orderkey") % 11 == 0, F.lit("unknown"))
        .otherwise(F.to_date("o_orderdate").cast("string")).alias("filed_date"),
        F.when(F.col("l_partkey") % 13 == 0, F.lit("13/45/2001"))
        .when(F.col("l_partkey") % 17 != 0, month_first).alias("issued_date"),
        F.col("l_shipdate").cast("string").alias("completed_date"),
        F.col("l_linestatus").alias("existing_use"), F.col("l_returnflag").alias("proposed_use"),
        F.col("l_extendedprice").alias("estimated_cost"),
        F.col("l_linenumber").cast("bigint").alias("existing_units"),
        F.col("l_quantity").cast("bigint").alias("proposed_units"),
        F.col("o_orderstatus").alias("neighborhoods_analysis_boundaries"),
        F.col("l_suppkey").cast("string").alias("zipcode"),
        F.col("o_orderstatus").alias("supervisor_district"))


def use_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as flows from the customer's to the supplier's nation, both labelled
    `REGION/NATION`. Some sources are written in lower case, so spellings differ."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    labels = nations.join(regions, nations.n_regionkey == regions.r_regionkey) \
        .select("n_nationkey", F.concat_ws("/", "r_name", "n_name").alias("_source"))
    orders = _orders_of(spark, sf_dir, labels).select("o_orderkey", "_source")
    targets = labels.select(F.col("n_nationkey").alias("_to"), F.col("_source").alias("_target"))
    suppliers = table(spark, sf_dir, "supplier")
    suppliers = suppliers.join(targets, suppliers.s_nationkey == targets._to) \
        .select("s_suppkey", "_target")
    spelled = F.when(F.col("l_orderkey") % 3 == 0, F.lower("_source")).otherwise(F.col("_source"))
    return (
        lines(spark, sf_dir)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(spelled.alias("existing_use"), F.col("_target").alias("proposed_use"))
    )


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as parcels: padded and blank residential types, some without a land use."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("blklot"), F.col("p_name").alias("street"),
        F.when(key % 19 != 0, F.col("p_brand")).alias("landuse"),
        F.when(key % 23 == 0, F.lit("   "))
        .when(key % 5 == 0, F.concat(F.lit("  "), "p_type", F.lit(" ")))
        .otherwise(F.col("p_type")).alias("restype"),
        F.col("p_size").cast("bigint").alias("units"))


def price_index_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw index readings."""
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 9 == 0, F.lit("."))
        .otherwise(F.to_date("o_orderdate").cast("string")).alias("observation_date"),
        F.col("o_totalprice").alias("value"))


def price_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly mean order price. Prices are summed as decimals, so the order of rows is no
    matter."""
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return table(spark, sf_dir, "orders") \
        .groupBy(F.date_trunc("quarter", "o_orderdate").cast("date").alias("observation_date")) \
        .agg((total / F.count("*")).alias("hpi_value"))


def census_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as raw tract rows with sentinels and empty tracts."""
    key = F.col("c_custkey")
    sentinel = F.lit(float(MISSING_SENTINEL))
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.when(key % 7 == 0, sentinel).otherwise(F.col("c_acctbal")).alias("median_rent"),
        F.when(key % 8 == 0, sentinel).otherwise(F.col("c_acctbal") * 2).alias("median_income"),
        (key % 10 * 100).alias("pop_total"), (key % 3 * 30).alias("pop_white"),
        F.lit("06").alias("state"),
        F.lpad((F.col("c_nationkey") * 4 + 1).cast("string"), 3, "0").alias("county"),
        key.cast("string").alias("tract"), F.concat(F.lit("06"), key.cast("string"))
        .alias("geoid"))


def census_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures as text under other names, with junk and unpadded county codes."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(key % 7 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
        .alias("MEDIAN_RENT"),
        F.when(key % 8 == 0, F.lit("-")).otherwise(F.col("c_acctbal").cast("string"))
        .alias("MEDIAN_INCOME"),
        (key % 10 * 100).cast("string").alias("POP_TOTAL"),
        (F.col("c_nationkey") * 4 + 1).cast("string").alias("COUNTY"))


def tracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as census tracts of the nation they are in; some without a positive income."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("tract"), F.col("s_acctbal").alias("median_income"),
        F.when(F.col("s_suppkey") % 6 != 0, F.col("s_acctbal") / 4).alias("median_rent"))


def _responses(df: DataFrame, key: str, fields: dict[str, Column], rows: int) -> DataFrame:
    """Rows packed into JSON responses as a web service would send them: a header row and at
    most `rows` rows each."""
    header = F.array(*map(F.lit, fields))
    return (
        df.groupBy(F.floor(F.col(key) / rows).alias("page"))
        .agg(F.collect_list(F.array(*fields.values())).alias("cells"))
        .select(F.to_json(F.concat(F.array(header), "cells")).alias("value"))
    )


def census_responses(spark: SparkSession, sf_dir: str, rows: int = 400) -> DataFrame:
    """Customers as JSON responses of the census service."""
    return _responses(table(spark, sf_dir, "customer"), "c_custkey", {
        "NAME": F.col("c_name"), "B25064_001E": F.col("c_acctbal").cast("string"),
        "tract": F.col("c_custkey").cast("string"),
        "county": F.lpad(F.col("c_nationkey").cast("string"), 3, "0")}, rows)


def supplier_responses(spark: SparkSession, sf_dir: str, rows: int = 400) -> DataFrame:
    """Suppliers as further responses, without a tract and with the fields in another order."""
    return _responses(table(spark, sf_dir, "supplier"), "s_suppkey", {
        "county": F.lpad(F.col("s_nationkey").cast("string"), 3, "0"), "NAME": F.col("s_name"),
        "B25064_001E": F.col("s_acctbal").cast("string")}, rows)


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as raw CSV lines: quoted commas, null tokens, short and long rows, bad numbers."""
    key = F.col("c_custkey")
    name = F.concat(F.lit('"'), F.col("c_name"), F.lit(', ""Ltd"""'))
    segment = F.when(key % 6 == 0, F.lit("NA")).when(key % 6 == 1, F.lit("NULL")) \
        .otherwise(F.col("c_mktsegment"))
    balance = F.when(key % 10 == 0, F.lit("n.a.")).otherwise(F.col("c_acctbal").cast("string"))
    whole = F.concat_ws(",", key, name, segment, balance, F.col("c_nationkey"))
    return table(spark, sf_dir, "customer").select(
        F.when(key % 14 == 1, F.concat_ws(",", key, name))
        .when(key % 14 == 2, F.concat(whole, F.lit(",surplus")))
        .otherwise(whole).alias("value"))
