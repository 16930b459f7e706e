"""What the physical plans must and must not contain, with broadcasts of unknown tables off."""

import re

import pytest
from oracle import TESTDATA

from burgage.operators import activity, cleaning, regions
from burgage.plans.bindings import census_raw, issued
from burgage.plans.catalog import QUERIES
from burgage.session import kept

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    made = {}

    def plan(name):
        if name not in made:
            df = QUERIES[name](spark, SF)
            df.collect()
            text = df._jdf.queryExecution().executedPlan().toString()
            made[name] = text.split("\n+- == Initial Plan ==")[0]
        return made[name]

    yield plan
    for key in keys:
        spark.conf.unset(key)


# reads the lines of a byte range in order, in Arrow batches, which no column expression can
IN_ORDER = {"csv_split_multiline"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - IN_ORDER))
def test_no_python_and_no_cartesian_product(plans, name):
    text = plans(name)
    for word in ("Python", "ArrowEval", "MapInArrow", "Cartesian", "BroadcastNestedLoop", "InPandas"):
        assert word not in text


@pytest.mark.parametrize("name, columns", [
    ("permits_trend", "l_returnflag,l_shipdate"),
    ("type_value_counts", "l_orderkey"),
    ("order_price_quantiles", "o_totalprice,o_orderpriority"),
    ("cost_box", "l_extendedprice,l_returnflag"),
    ("housing_types", "p_partkey,p_brand,p_type"),
])
def test_scans_read_only_their_columns(plans, name, columns):
    read = [set(re.sub(r"#\d+L?", "", c).split(","))
            for c in re.findall(r"FileScan parquet \[([^\]]*)\]", plans(name))]
    assert set(columns.split(",")) in read


@pytest.mark.parametrize("name", ["permits_trend", "trend_top_types", "neighborhood_ranked"])
def test_year_ranges_reach_the_scan(plans, name):
    assert re.search(r"DataFilters: \[[^\]]*\(l_shipdate#\d+ >= 1996-01-01", plans(name))


@pytest.mark.parametrize("name, scans", [
    ("permits_trend", 1), ("processing_stats", 2), ("processing_time_box", 2), ("trend_top_types", 2),
    ("peak_years", 2), ("neighborhood_ranked", 4), ("cost_box", 1),
    ("income_vs_wait", 5), ("change_of_use_merged_words", 6),
])
def test_each_table_is_read_once(plans, name, scans):
    assert plans(name).count("FileScan") == scans


def test_links_and_nodes_come_from_one_table(plans):
    text = plans("sankey_links")
    assert "/edges-" in text and not re.search(r"(lineitem|orders|customer|supplier|nation|region)\.parquet", text)


def test_each_date_is_parsed_once(plans):
    text = plans("permits_clean")
    assert text.count("regexp_replace(") == 4  # three dates and the capitalised type
    assert not re.search(r"DataFilters: \[[^\]]*regexp_replace", text)


def test_markers_read_the_tracts_once(plans, spark):
    """All of the markers' figures come from one table, which one scan of the tracts has made."""
    text = plans("county_markers")
    assert "customer.parquet" not in text and "/figures-" in text
    made = regions._figures(cleaning.clean_census(census_raw(spark, SF)), "county", "median_rent", "median_income",
                            "pop_total", "tract", True, False)
    assert made._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_a_kept_table_is_read_from_memory(spark):
    with kept(issued(spark, SF)) as permits:
        plan = activity.trend(permits)._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" in plan
    plan = activity.trend(issued(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" not in plan


def test_total_of_shares_reuses_the_counts(plans):
    final = plans("top_share").split("== Initial Plan ==")[0]
    assert "Subquery" in final and "ReusedExchange" in final and "FileScan" not in final


@pytest.mark.parametrize("name", ["neighborhood_activity", "change_of_use", "use_type_counts"])
def test_top_k_is_no_full_sort(plans, name):
    assert "TakeOrderedAndProject" in plans(name)


# the bindings of these pack raw rows, at most 400 at a time, into responses
PACKED = {"census_landing", "appended_responses", "census_landed", "landed_responses"}


def beneath(text, at):
    """What is printed after `at`, with the exchanges that it uses again and what lies below them."""
    found, todo, seen = text[at:], [text[at:]], set()
    while todo:
        for number in set(re.findall(r"ReusedExchange [^\n]*\[plan_id=(\d+)\]", todo.pop())) - seen:
            seen.add(number)
            first = re.search(rf"(?m)^(?!.*ReusedExchange).*Exchange [^\n]*\[plan_id={number}\]", text)
            assert first, f"exchange {number} is not in the plan"
            found += text[first.end():]
            todo.append(text[first.end():])
    return found


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PACKED - IN_ORDER))
def test_windows_and_percentiles_follow_an_aggregate(plans, name):
    text = plans(name)
    for word in ("Window [", "ObjectHashAggregate"):
        for match in re.finditer(re.escape(word), text):
            below = beneath(text, match.end()).replace("ObjectHashAggregate", "")
            assert "HashAggregate" in below or "TakeOrdered" in below


def test_no_task_has_the_whole_export(spark, monkeypatch):
    """One file comes of parts that all tasks write, not of all rows in one task."""
    frame = type(spark.range(0))
    monkeypatch.setattr(frame, "repartition", lambda self, n, *c, f=frame.repartition: f(
        self, n, *c) if n != 1 or self.columns == ["place", "pieces"] else pytest.fail("all rows in one task"))
    assert QUERIES["csv_split_multiline"](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_lines_are_shuffled_once_for_places(plans):
    text = plans("neighborhood_activity")
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", text)) == 1
    assert "hashpartitioning(o_custkey" in text  # orders meet customers before the lines do
    assert text.index("hashpartitioning(l_orderkey") < text.index("hashpartitioning(o_custkey")
