"""The named reports over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (clean_header, days_between, initcap_words, label_for, number_or_null,
                         quarter_label, thousands, zero_fill)
from ..operators import activity, cleaning, combined, flows, quantiles, ranking, regions
from ..operators import profile as profiles
from ..operators import series, timing, views
from ..operators.areas import points_in_areas
from ..schemas import CENSUS_VARIABLES, COUNTIES, SAMPLE_ROWS, layout
from ..session import kept, scratch_path, written
from ..sources import (Typed, append_all, decode_json_table, export_all, export_csv, export_one_csv, latest,
                       read_csv, read_csv_inferred, read_csv_split, read_json_tables, read_ledger, register_view,
                       rejected_responses, settle, type_columns, upsert, write_table)
from . import bindings as b

Query = Callable[[SparkSession, str], DataFrame]

YEARS = (1996, 2000)
ALL_YEARS = (1, 9998)
SAMPLE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
CUSTOMER_LAYOUT = layout("custkey:long name segment balance:money nationkey:long")


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded for comparison; decimals as doubles; smaller integers as bigint."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind == "double" or kind.startswith("decimal"):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        elif kind in ("integer", "short", "byte"):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# ---- cleaning ----

def permits_clean(spark, sf):
    return cleaning.clean_permits(b.permits_text(spark, sf))


def permits_clean_narrow(spark, sf):
    return cleaning.clean_permits(
        b.permits_text(spark, sf), cleaning.NARROW_PERMIT_ROLES, days_range=(0, 1000),
        initcap_mode="space", date_suffix="_ts")


def land_use_clean(spark, sf):
    return cleaning.clean_land_use(b.parcels(spark, sf), keep=("blklot", "street", "units"))


def hpi_clean(spark, sf):
    return cleaning.clean_price_index(b.price_index_text(spark, sf))


def census_clean(spark, sf):
    return rounded(cleaning.clean_census(b.census_raw(spark, sf)))


# ---- counts over time and places ----

def quality_summary(spark, sf):
    return rounded(activity.quality_summary(b.placed(spark, sf)))


def permits_trend(spark, sf):
    return activity.trend(b.issued(spark, sf, YEARS), years=YEARS)


def trend_top_types(spark, sf):
    counts = activity.trend(b.issued_by_brand(spark, sf, YEARS), years=YEARS)
    return activity.trend_top_types(counts, 5)


def neighborhood_activity(spark, sf):
    return rounded(activity.place_activity(b.placed(spark, sf), 20))


def neighborhood_activity_all(spark, sf):
    return activity.place_activity(b.placed(spark, sf), None, cost=None, round_to=1)


def neighborhood_ranked(spark, sf):
    timely = b.placed(spark, sf, YEARS).filter(F.col("processing_days").between(0, 1000))
    return rounded(activity.places_ranked(timely, years=YEARS))


def housing_types(spark, sf):
    clean = cleaning.clean_land_use(b.parcels(spark, sf), keep=())
    return activity.category_counts(clean, "restype", name="parcel_count")


def housing_types_bar(spark, sf):
    return ranking.ranked_bar(housing_types(spark, sf), "parcel_count", "restype")


def use_type_counts(spark, sf):
    return activity.category_counts(b.issued_by_brand(spark, sf), "existing_use", 12)


def top_share(spark, sf):
    return rounded(activity.top_share(b.placed(spark, sf), 5), 6)


def peak_years(spark, sf):
    return activity.peak_years(activity.trend(b.issued_by_brand(spark, sf), years=ALL_YEARS))


def type_value_counts(spark, sf):
    return ranking.value_counts(b.timed(spark, sf), "permit_type")


# ---- durations ----

def processing_time(spark, sf):
    return timing.processing_time(b.timed(spark, sf))


def processing_time_sample(spark, sf):
    timely = b.timed(spark, sf).filter(F.col("processing_days").between(0, 1000)) \
        .select(*SAMPLE_KEYS, "permit_type", "processing_days")
    return rounded(ranking.sample_rows(timely, SAMPLE_ROWS, SAMPLE_KEYS)
                   .select("permit_type", "processing_days"))


def processing_stats(spark, sf):
    timely = b.timed(spark, sf).filter(F.col("processing_days").between(0, 1000))
    return timing.processing_stats(timely)


def processing_stats_all_days(spark, sf):
    return timing.processing_stats(b.timed(spark, sf))


def processing_time_top_types(spark, sf):
    days = b.timed(spark, sf).filter(F.col("processing_days").between(0, 1000)) \
        .select("permit_type", "processing_days")
    return timing.processing_time_top_types(days, 3)


def processing_time_box(spark, sf):
    days = timing.processing_time(b.timed(spark, sf))
    return rounded(timing.box_summary(days, "processing_days", "permit_type", k=3,
                                      bounded_values=True))


def cost_box(spark, sf):
    lines = b.table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    return rounded(timing.box_summary(lines, "l_extendedprice", "l_returnflag"))


# ---- flows ----

def change_of_use(spark, sf):
    return flows.change_of_use(b.use_changes(spark, sf), 15)


def change_of_use_merged(spark, sf):
    return flows.change_of_use(b.use_changes(spark, sf), 15, normalise="before",
                               initcap_mode="space")


def change_of_use_merged_words(spark, sf):
    """Merged by labels that are capitalised after punctuation as well."""
    return flows.change_of_use(b.use_changes(spark, sf), 15, normalise="before")


def sankey_nodes(spark, sf):
    return flows.sankey_nodes(change_of_use_merged_words(spark, sf))


def sankey_links(spark, sf):
    return flows.sankey_links(change_of_use_merged_words(spark, sf))


def _all_flows(spark: SparkSession, sf: str) -> DataFrame:
    return flows.change_of_use(b.use_changes(spark, sf), None, normalise="before")


def sankey_nodes_all(spark, sf):
    return flows.sankey_nodes(_all_flows(spark, sf))


def sankey_links_all(spark, sf):
    return flows.sankey_links(_all_flows(spark, sf))


# ---- two tables ----

def income_vs_wait(spark, sf):
    return rounded(combined.income_vs_wait(b.placed(spark, sf), b.tracts(spark, sf),
                                           place="segment"))


def income_vs_wait_keep_unmatched(spark, sf):
    return rounded(combined.income_vs_wait(b.placed(spark, sf), b.tracts(spark, sf),
                                           place="segment", keep_unmatched=True))


def income_wait_scatter(spark, sf):
    report = combined.income_vs_wait(b.placed(spark, sf), b.tracts(spark, sf))
    return rounded(combined.income_wait_scatter(report))


def permits_vs_hpi(spark, sf):
    counts = activity.trend(b.issued(spark, sf, YEARS), years=YEARS)
    return rounded(combined.permits_vs_index(counts, b.price_index(spark, sf), years=YEARS))


def hpi_series(spark, sf):
    return rounded(series.index_series(b.price_index(spark, sf)))


# ---- regions ----

def county_stats(spark, sf):
    return rounded(regions.county_stats(cleaning.clean_census(b.census_raw(spark, sf))))


def county_stats_from_text(spark, sf):
    raw = b.census_as_text(spark, sf)
    county = regions.find_column(raw, "county")
    return rounded(regions.county_stats(
        raw, county=county, rent=regions.find_column(raw, "rent"),
        income=regions.find_column(raw, "income"),
        population=regions.find_column(raw, "pop_total"),
        drop_missing_rent=False, fill_code=True))


def colour_bounds(spark, sf):
    return rounded(regions.colour_bounds(cleaning.clean_census(b.census_raw(spark, sf))))


def county_markers(spark, sf):
    clean = cleaning.clean_census(b.census_raw(spark, sf))
    return rounded(regions.county_markers(*regions.county_stats_and_bounds(clean)))


def county_markers_fixed_range(spark, sf):
    raw = b.census_as_text(spark, sf)
    stats = regions.county_stats(
        raw, county="COUNTY", rent="MEDIAN_RENT", income="MEDIAN_INCOME",
        population="POP_TOTAL", drop_missing_rent=False, fill_code=True)
    return rounded(regions.county_markers(stats, digits=2))


def order_price_quantiles(spark, sf):
    return rounded(quantiles.exact_quantiles(
        b.table(spark, sf, "orders"), "o_totalprice", (0.1, 0.5, 0.9), ["o_orderpriority"],
        ["p10", "p50", "p90"]))


def event_time_quantiles(spark, sf):
    """Of times in microseconds, which differ in their last digits only."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return rounded(quantiles.exact_quantiles(
        b.table(spark, sf, "events").select("event_type", micros.alias("micros")), "micros",
        (0.1, 0.5, 0.9), ["event_type"], ["p10", "p50", "p90"]), 0)


def cost_stats(spark, sf):
    """Statistics of a measure that is no whole number of days."""
    lines = b.table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    return rounded(timing.processing_stats(
        lines, category="l_returnflag", days="l_extendedprice", digits=1, whole_days=False), 1)


def attached_areas(spark, sf):
    areas = b.table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("06"), F.col("o_custkey").cast("string")).alias("geoid"))
    stats = cleaning.clean_census(b.census_raw(spark, sf)).select("geoid", "median_rent")
    return rounded(regions.attach_areas(areas, stats))


# ---- loading and writing ----

def census_landing(spark, sf):
    columns = {**{k: v for k, v in CENSUS_VARIABLES.items() if k in ("NAME", "B25064_001E")},
               "county": "county", "tract": "tract"}
    rows = decode_json_table(b.census_responses(spark, sf), columns)
    return cleaning.with_geoid(rows.withColumn("state", F.lit("06")))


def appended_responses(spark, sf):
    """Customers and suppliers, from responses of their own that order their fields differently."""
    fields = {"NAME": "name", "B25064_001E": "median_rent", "county": "county"}
    return append_all([
        decode_json_table(b.census_responses(spark, sf), {**fields, "tract": "tract"}),
        decode_json_table(b.supplier_responses(spark, sf), fields)])


def census_landed(spark, sf):
    """The responses as files, read again with one file among them that is no table."""
    path = scratch_path(spark, "census-responses")
    broken = b.table(spark, sf, "region").filter("r_regionkey = 0").select(F.lit("no table").alias("value"))
    b.census_responses(spark, sf).union(broken).write.option("maxRecordsPerFile", 1).text(path)
    landed = read_json_tables(spark, path)
    rows = decode_json_table(landed, {"NAME": "name", "county": "county", "tract": "tract"})
    return rows.unionByName(rejected_responses(landed).select(
        F.trim(F.replace("value", F.lit("\n"))).alias("name")), allowMissingColumns=True)


_customer_lines: dict[tuple[str, str], str] = {}


def _loaded_customers(spark: SparkSession, sf: str) -> Typed:
    """The lines are written once per application, for the loaded rows and for the rejects."""
    key = spark.sparkContext.applicationId, sf
    if key not in _customer_lines:
        path = scratch_path(spark, "customer-lines")
        b.customer_lines(spark, sf).write.text(path)
        _customer_lines[key] = path
    path = _customer_lines[key]
    return type_columns(read_csv(spark, path, CUSTOMER_LAYOUT, header=False), CUSTOMER_LAYOUT)


def csv_load(spark, sf):
    return rounded(_loaded_customers(spark, sf).good)


def csv_rejects(spark, sf):
    rejects = _loaded_customers(spark, sf).rejects
    return rejects.withColumn("bad_columns", F.array_join("bad_columns", ","))


def csv_export_multiline(spark, sf):
    """Texts with line breaks and quotes, out to CSV and back."""
    path = scratch_path(spark, "documents-csv")
    export_csv(b.table(spark, sf, "documents").select("doc_id", "lang", "text"), path)
    back = type_columns(read_csv(spark, path, layout("doc_id:long lang text"), multiline=True,
                                 tokens=("",)), layout("doc_id:long lang text")).good
    return back.select("doc_id", "lang", F.length("text").cast("bigint").alias("text_length"),
                       F.md5("text").alias("text_md5"))


def csv_inferred(spark, sf):
    """Orders out to CSV and back by header, with inferred types."""
    path = scratch_path(spark, "orders-csv")
    export_csv(b.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Order Key"), F.col("o_totalprice").alias("Total - Price"),
        F.to_date("o_orderdate").alias("Order Date"), F.col("o_orderstatus").alias("status")), path)
    return rounded(read_csv_inferred(spark, path, clean_names=True))


def stored_trend(spark, sf):
    """The cleaned table, stored by issue year; the trend reads only the years it needs."""
    path = scratch_path(spark, "permits-clean")
    write_table(permits_clean(spark, sf).select("permit_type", "issued_year", "processing_days"),
                path, partition_by=["issued_year"])
    stored = spark.read.parquet(path)
    return activity.trend(stored, years=YEARS).select(
        F.col("issued_year").cast("bigint").alias("issued_year"), "permit_type", "permit_count")


def view_trend(spark, sf):
    """The trend as a query on a registered view."""
    register_view(b.issued(spark, sf, YEARS), "issued_permits")
    return spark.sql("""SELECT issued_year, permit_type, count(*) AS permit_count
                        FROM issued_permits GROUP BY issued_year, permit_type""")


def kept_trend(spark, sf):
    """Two reports from one table that is kept until both are written."""
    with kept(b.issued(spark, sf, YEARS)) as permits:
        trend = written(activity.trend(permits, years=YEARS), "kept-trend")
        return trend.withColumn("all_permits", F.lit(permits.count()))


def stored_once(spark, sf):
    """A second write to a table that is there changes nothing."""
    path = scratch_path(spark, "parcels")
    parcels = b.parcels(spark, sf).select("blklot", "landuse", "units")
    write_table(parcels, path, mode="ignore")
    write_table(parcels.filter("units < 10"), path, mode="ignore")
    return spark.read.parquet(path)


def exported_views(spark, sf):
    """Two reports, each exported to one file and read back."""
    views = {"housing": housing_types(spark, sf).select(F.col("restype").alias("label"),
                                                        F.col("parcel_count").alias("n")),
             "types": type_value_counts(spark, sf).select(F.col("permit_type").alias("label"),
                                                          F.col("row_count").alias("n"))}
    paths = export_all(views, scratch_path(spark, "views"), single_file=True,
                       orders={name: ["label"] for name in views})
    return append_all([
        type_columns(read_csv(spark, path, layout("label n:long")), layout("label n:long")).good
        .withColumn("view", F.lit(name)) for name, path in paths.items()])


def table_profile(spark, sf):
    return profiles.profile(b.tables(spark, sf))


def label_texts(spark, sf):
    """Label and number formatting on every order."""
    names = {code: name for code, name, _, _ in COUNTIES}
    orders = b.table(spark, sf, "orders")
    code = zero_fill(F.col("o_custkey") % 100)
    return profiles.by_position(orders.select(
        "o_orderkey",
        initcap_words(F.replace("o_orderpriority", F.lit(" "), F.lit("/"))),
        initcap_words("o_orderpriority", "space"),
        code, label_for(code, names), quarter_label("o_orderdate"),
        thousands("o_totalprice", 2, "$"),
        number_or_null(F.when(F.col("o_orderkey") % 4 == 0, F.lit("NaN"))
                       .when(F.col("o_orderkey") % 4 == 1, F.lit("x"))
                       .otherwise(F.col("o_orderkey").cast("string"))),
    ), clean_header(" O Orderkey"), "words", "spaced", "code", "county", "quarter", "price_text",
        "number")


# ---- large files, new batches, amended rows ----

def csv_split_multiline(spark, sf):
    """Texts with line breaks and quotes out to one CSV file, and back by ranges of it."""
    path = scratch_path(spark, "documents-one-csv")
    export_one_csv(b.table(spark, sf, "documents").select("doc_id", "lang", "text"), path)
    shape = layout("doc_id:long lang text")
    back = type_columns(read_csv_split(spark, path, shape, tokens=("",)), shape).good
    return back.select("doc_id", "lang", F.length("text").cast("bigint").alias("text_length"),
                       F.md5("text").alias("text_md5"))


BATCHES = ((1900, 1993), (1994, 1996), (1997, 2100))


def _folded(spark: SparkSession, sf: str, rows: Callable[..., DataFrame], name: str,
            view: views.View) -> DataFrame:
    """A view over batches by ship date, of which the second is delivered twice."""
    path = scratch_path(spark, "states")
    for i in (0, 1, 2, 1):
        views.fold(rows(spark, sf, BATCHES[i]), {name: view}, path, f"ship-{i}")
    return views.folded(spark, {name: view}, path)[name]


def merged_trend(spark, sf):
    return _folded(spark, sf, b.issued, "trend", views.trend(YEARS))


def merged_activity(spark, sf):
    return rounded(_folded(spark, sf, b.placed, "places", views.place_activity(20)))


def merged_quality(spark, sf):
    return rounded(_folded(spark, sf, b.placed, "quality", views.quality_summary()))


def merged_stats(spark, sf):
    return _folded(spark, sf, b.placed, "stats", views.processing_stats())


def merged_quantiles(spark, sf):
    """Exact quantiles over batches, of a measure that differs in most rows."""
    view = views.value_quantiles("l_extendedprice", (0.1, 0.5, 0.9), ("l_returnflag",), ("p10", "p50", "p90"))
    return rounded(_folded(spark, sf, b.lines, "prices", view))


def report_pack(spark, sf):
    """Five reports from one scan, below each other."""
    rows = b.placed(spark, sf).withColumns({"existing_use": F.col("segment"),
                                            "proposed_use": F.col("permit_type")})
    found = views.reports(rows, {
        "trend": views.trend(YEARS), "places": views.place_activity(20), "quality": views.quality_summary(),
        "stats": views.processing_stats(), "uses": views.change_of_use(15)})
    shapes = {"trend": ("issued_year", "permit_type", "permit_count", None),
              "places": ("neighborhood", None, "total_permits", "avg_processing_days"),
              "quality": (None, None, "total_rows", "avg_processing_days"),
              "stats": ("permit_type", None, "count", "median_days"),
              "uses": ("existing_use", "proposed_use", "flow_count", None)}

    def shown(name: str, kind: str, alias: str, column: str | None):
        return (F.lit(None) if column is None else F.col(column)).cast(kind).alias(alias)

    return append_all([rounded(found[report].select(
        F.lit(report).alias("report"), shown(report, "string", "label", first),
        shown(report, "string", "second", second), shown(report, "bigint", "n", n),
        shown(report, "double", "amount", amount))) for report, (first, second, n, amount) in shapes.items()])


def upserted_permits(spark, sf):
    """Lines as a stored table by year, with new, amended, outdated and deleted rows put in."""
    path = scratch_path(spark, "permits-upserted")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("permit_number")
    lines = written(latest(b.lines(spark, sf).select(
        key, F.col("l_orderkey").alias("o"), F.year("l_shipdate").cast("bigint").alias("issued_year"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("cost"),
        F.to_date("l_shipdate").alias("as_of")), ["permit_number"], "cost"), "lines")
    base = lines.where("o % 17 <> 0")
    write_table(base.select("permit_number", "cost", "as_of", "issued_year"), path, partition_by=["issued_year"])
    moved = F.when(F.col("o") % 7 == 0, F.col("issued_year") + 1).otherwise(F.col("issued_year"))
    changes = lines.where("o % 7 = 0 OR o % 11 = 0 OR o % 13 = 0 OR o % 17 = 0").select(
        "permit_number", (F.col("cost") * 2).cast("decimal(18,2)").alias("cost"),
        F.when((F.col("o") % 11 == 0) & (F.col("o") % 7 != 0) & (F.col("o") % 13 != 0) & (F.col("o") % 17 != 0),
               F.date_sub("as_of", 10)).otherwise(F.date_add("as_of", 30)).alias("as_of"),
        moved.alias("issued_year"), ((F.col("o") % 13 == 0) & (F.col("o") % 17 != 0)).alias("withdrawn"))
    earlier = changes.withColumns({"cost": F.lit(0).cast("decimal(18,2)"), "as_of": F.date_sub("as_of", 50),
                                   "withdrawn": F.lit(False)})
    upsert(path, changes.union(earlier), ["permit_number"], "as_of", "issued_year", deleted="withdrawn")
    return rounded(spark.read.parquet(path).withColumn("issued_year", F.col("issued_year").cast("bigint")))


def landed_responses(spark, sf):
    """Responses landed in three runs: some come again under other names, and some are changed."""
    folder, ledger = scratch_path(spark, "landing"), scratch_path(spark, "ledger")
    whole = b.census_responses(spark, sf)
    half = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    runs = []
    for name, rows in (("first", whole.where(half)), ("second", whole), ("third", whole.where(~half))):
        rows.write.option("maxRecordsPerFile", 1).text(f"{folder}/{name}")
        runs.append(settle(spark, folder, ledger, "*.txt").groupBy("state").agg(F.count("*").alias("files"))
                    .withColumn("run", F.lit(name)))
    loaded = read_ledger(spark, ledger).where("state = 'loaded'").select("path")
    landed = read_json_tables(spark, folder, recursive=True).join(loaded, "path", "left_semi")
    rows = decode_json_table(landed, {"NAME": "name", "tract": "tract"})
    return rows.select("name", "tract")


def top_parts(spark, sf):
    """The most ordered of very many parts."""
    return ranking.top_by_threshold(b.table(spark, sf, "lineitem"), "l_partkey", 15)


def column_votes(spark, sf):
    """Orders out to CSV, and what each column of the texts can be read as."""
    path = scratch_path(spark, "orders-votes")
    export_csv(b.table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderstatus",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("o_custkey"),
        (F.col("o_orderkey") % 2 == 0).alias("is_even"),
        F.when(F.col("o_orderkey") % 100 == 1, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))
        .alias("mixed")), path)
    text = read_csv(spark, path, layout("o_orderkey o_totalprice o_orderdate o_orderstatus o_custkey is_even mixed"))
    return rounded(profiles.type_votes(text)).select(
        "column_name", "voted_type", "rows", "nulls", "n_boolean", "n_bigint", "n_double", "n_date",
        "n_timestamp_ntz", F.when(F.col("voted_type") != "double", F.col("least")).alias("least"),
        F.when(F.col("voted_type") != "double", F.col("most")).alias("most"))


_bucketed: dict[tuple[str, str], dict[str, str]] = {}


def _bucketed_tables(spark: SparkSession, sf: str) -> dict[str, str]:
    """Lines and orders, bucketed by order once per application."""
    key = spark.sparkContext.applicationId, sf
    if key not in _bucketed:
        names = {}
        for t, column, columns in (("lineitem", "l_orderkey", ("l_orderkey", "l_shipdate")),
                                   ("orders", "o_orderkey", ("o_orderkey", "o_orderdate", "o_orderpriority"))):
            path = scratch_path(spark, f"bucketed_{t}")
            names[t] = path.rsplit("/", 1)[1].replace("-", "_")
            write_table(b.table(spark, sf, t).select(*columns), path, table=names[t], bucket_by=[column], buckets=16)
        _bucketed[key] = names
    return _bucketed[key]


def bucketed_stats(spark, sf):
    """Statistics of the days from order to shipment, from tables that join without a shuffle."""
    names = _bucketed_tables(spark, sf)
    lines, orders = spark.table(names["lineitem"]), spark.table(names["orders"])
    timely = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderpriority").alias("permit_type"),
        days_between("o_orderdate", "l_shipdate").alias("processing_days")).filter(
        F.col("processing_days").between(0, 1000))
    return timing.processing_stats(timely)


def customers_in_areas(spark, sf):
    """Customers as points in the diamonds, with a hole each, that suppliers stand for."""
    points = b.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("x"), (F.col("c_custkey") * 37 % 10000).cast("double").alias("y"))
    y, r = F.col("s_suppkey") * 53 % 10000, 200 + F.col("s_nationkey") * 40

    def ring(size):
        corners = ((size, 0), (0, size), (-size, 0), (0, -size), (size, 0))
        return F.concat(F.lit("("), F.concat_ws(", ", *[F.concat_ws(
            " ", (F.col("s_acctbal") + dx).cast("string"), (y + dy).cast("string")) for dx, dy in corners]), F.lit(")"))

    areas = b.table(spark, sf, "supplier").select(
        "s_suppkey", F.concat(F.lit("MULTIPOLYGON (("), ring(r), F.lit(", "), ring(r / 4), F.lit("))")).alias("geom"))
    return points_in_areas(points, areas, x="x", y="y", area_id="s_suppkey", wkt="geom", cell=250.0,
                           name="area").select("c_custkey", "area")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    permits_clean, permits_clean_narrow, land_use_clean, hpi_clean, census_clean,
    quality_summary, permits_trend, trend_top_types, neighborhood_activity,
    neighborhood_activity_all, neighborhood_ranked, housing_types, housing_types_bar,
    use_type_counts, top_share, peak_years, type_value_counts,
    processing_time, processing_time_sample, processing_stats, processing_stats_all_days,
    processing_time_top_types, processing_time_box, cost_box,
    change_of_use, change_of_use_merged, change_of_use_merged_words, sankey_nodes, sankey_links,
    sankey_nodes_all, sankey_links_all,
    income_vs_wait, income_vs_wait_keep_unmatched, income_wait_scatter, permits_vs_hpi,
    hpi_series, county_stats, county_stats_from_text, colour_bounds, county_markers,
    county_markers_fixed_range, order_price_quantiles, event_time_quantiles, cost_stats,
    attached_areas,
    census_landing, census_landed, appended_responses, csv_load, csv_rejects, csv_export_multiline,
    csv_inferred, stored_trend, stored_once, view_trend, kept_trend, exported_views, table_profile,
    label_texts,
    csv_split_multiline, merged_trend, merged_activity, merged_quality, merged_stats, merged_quantiles,
    report_pack, upserted_permits, landed_responses, top_parts, column_votes, bucketed_stats,
    customers_in_areas,
)}
