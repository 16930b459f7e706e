"""Mergeable views, the report pack, exact top-k by thresholds, type votes and bucketed tables."""

import random
import re
from collections import Counter
from decimal import Decimal

import pytest
from oracle import TESTDATA
from pyspark.sql import functions as F

from burgage.operators import activity, flows, profile, quantiles, ranking, timing, views
from burgage.plans import bindings, catalog
from burgage.schemas import layout
from burgage.sources import read_csv, write_table

SF = f"{TESTDATA}/sf0.001"
ROWS = ("issued_year long, permit_type string, neighborhood string, processing_days long, estimated_cost decimal(18,2), "
        "existing_use string, proposed_use string")


def some(spark, seed, n):
    rng = random.Random(seed)
    pick = lambda *x: rng.choice([*x, None])
    return spark.createDataFrame([(
        pick(1999, 2000, 2003), pick("a", "b"), pick("x", "y", "z"), pick(-1, 0, 5, 70, 1000, 1001), Decimal(rng.randint(0, 99)),
        pick("u", "v"), pick("u", "w")) for _ in range(n)], ROWS)


ALL = {"trend": views.trend(), "places": views.place_activity(2), "quality": views.quality_summary(),
       "stats": views.processing_stats(), "uses": views.change_of_use(3),
       "costs": views.value_quantiles("estimated_cost", (0.25, 0.5), ("permit_type",), ("q1", "q2"))}


def single(rows):
    return {
        "trend": activity.trend(rows), "places": activity.place_activity(rows, 2), "quality": activity.quality_summary(rows),
        "stats": timing.processing_stats(timing.processing_time(rows)), "uses": flows.change_of_use(rows, 3, initcap_mode="space").select(
            F.lower("existing_use").alias("existing_use"), F.lower("proposed_use").alias("proposed_use"), "flow_count"),
        "costs": quantiles.exact_quantiles(rows, "estimated_cost", (0.25, 0.5), ["permit_type"], ["q1", "q2"])}


def same(got, want):
    assert set(got) == set(want)
    for name in want:
        assert got[name].columns == want[name].columns, name
        assert Counter(map(tuple, got[name].collect())) == Counter(map(tuple, want[name].collect())), name


@pytest.mark.parametrize("n", [0, 1, 300])
def test_pack_equals_single_reports(spark, n):
    rows = some(spark, n, n)
    same(views.reports(rows, ALL), single(rows))


def test_batches_equal_one_run(spark, tmp_path):
    """Three batches, one of them empty, one delivered again with amended rows."""
    path = str(tmp_path / "states")
    parts = [some(spark, i, n) for i, n in enumerate((120, 80, 200, 0))]
    for i in (0, 1, 3):
        views.fold(parts[i], ALL, path, f"day-{i}")
    same(views.folded(spark, ALL, path), single(parts[0].union(parts[1])))
    views.fold(parts[2], ALL, path, "day-1")
    same(views.folded(spark, ALL, path), single(parts[0].union(parts[2])))
    views.fold(parts[3], ALL, path, "day-0")
    same(views.folded(spark, ALL, path), single(parts[2]))
    views.compact(spark, ALL, path, str(tmp_path / "one"), "all")
    same(views.folded(spark, ALL, str(tmp_path / "one")), single(parts[2]))


def test_batch_names(spark, tmp_path):
    with pytest.raises(ValueError):
        views.fold(some(spark, 1, 3), {"trend": views.trend()}, str(tmp_path), "../x")
    assert not list(tmp_path.iterdir())


def test_sketches_merge(spark, tmp_path):
    view = {"distinct": views.distinct_values("id", ("g",))}
    rows = spark.range(30_000).select((F.col("id") % 2).alias("g"), "id")
    for i in range(3):
        views.fold(rows.where(F.col("id") < 10_000 * (i + 2)), view, str(tmp_path), f"b{i}")
    got = {r.g: r.distinct_values for r in views.folded(spark, view, str(tmp_path))["distinct"].collect()}
    assert all(abs(got[g] - 15_000) < 450 for g in (0, 1))


def test_pack_scans_once(spark):
    """One scan of the rows, whatever the number of reports."""
    rows = bindings.issued(spark, SF)
    two = {"trend": views.trend(), "types": views.View(("permit_type",), {"n": views.count()}, lambda s: s)}
    plans = []
    original = views.written
    try:
        views.written = lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), original(df, name))[1]
        found = views.reports(rows, two)
    finally:
        views.written = original
    assert len(plans) == 1 and plans[0].count("FileScan") == 1 and "Expand" in plans[0]
    assert all("lineitem" not in df._jdf.queryExecution().executedPlan().toString() for df in found.values())


# ---- top-k ----

@pytest.mark.parametrize("bins", [1, 7, 1 << 16])
def test_thresholds_find_the_same(spark, bins):
    rng = random.Random(4)
    rows = [(f"c{int(rng.paretovariate(0.7))}",) for _ in range(4000)] + [(None,)] * 50 + [(f"t{i}",) for i in range(99) for _ in (0, 1)]
    df = spark.createDataFrame(rows, "c string")
    for k in (1, 5, 40, 10_000):
        assert ranking.top_by_threshold(df, "c", k, bins).collect() == ranking.top_categories(df, "c", k).collect()
    assert ranking.top_by_threshold(df.where("false"), "c", 3).collect() == []


def shuffled_rows(df):
    """Rows that the exchanges of an executed plan have written."""
    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        own = node.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_thresholds_shuffle_little(spark):
    """Of 200,000 categories most are never counted by themselves."""
    df = spark.range(400_000).select(F.when(F.col("id") % 4 == 0, F.col("id") % 10).otherwise(F.col("id")).alias("c"))
    plain, fast = ranking.top_categories(df, "c", 5), ranking.top_by_threshold(df, "c", 5)
    assert fast.collect() == plain.collect()
    assert shuffled_rows(fast) < 0.01 * shuffled_rows(plain)


# ---- votes ----

def test_votes_and_layout(spark, tmp_path):
    text = spark.createDataFrame([
        ("1", "1.5", "2020-01-05", "true", "x", None, "1/5/2020 10:00:00", "9223372036854775808"),
        (" 22 ", "NaN?", "2020-1-6", "FALSE", "", None, "2020-01-05", "1"),
        (None, "1e3", None, "false", "1", None, None, None)], "i string, d string, `a date` string, b string, s string, e string, t string, w string")
    votes = {r.column_name: r for r in profile.type_votes(text, heavy=3).collect()}
    assert {n: v.voted_type for n, v in votes.items()} == {
        "i": "bigint", "d": "string", "a date": "date", "b": "boolean", "s": "string", "e": "string",
        "t": "timestamp_ntz", "w": "double"}
    assert (votes["i"].rows, votes["i"].nulls, votes["i"].least, votes["i"].most, votes["i"].longest) == (3, 1, "1", "22", 4)
    assert (votes["d"].n_double, votes["d"].nulls, votes["e"].nulls, votes["e"].least) == (2, 0, 3, None)
    assert votes["b"].distinct_values == 3 and votes["s"].heavy_values[0]["count"] == 1
    shape = profile.voted_layout(profile.type_votes(text))
    assert [f.dataType.simpleString() for f in shape.fields] == [
        "bigint", "string", "date", "boolean", "string", "string", "timestamp_ntz", "double"]
    assert profile.type_votes(text.where("false")).select("voted_type").distinct().collect() == [("string",)]


def test_votes_take_one_pass(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b")).write.csv(path)
    votes = profile.type_votes(read_csv(spark, path, layout("a b"), header=False))
    text = votes._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and {r.voted_type for r in votes.collect()} == {"bigint", "string"}


# ---- buckets ----

def test_bucketed_tables_join_without_a_shuffle(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        df = catalog.bucketed_stats(spark, SF)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    finally:
        for key in keys:
            spark.conf.unset(key)
    join = re.search(r"SortMergeJoin|ShuffledHashJoin", text)
    assert join and "Exchange" not in text[join.end():]


def test_bucketed_tables_need_a_name(spark, tmp_path):
    for more in ({"path": str(tmp_path)}, {"table": "t", "partition_by": ["id"]}):
        with pytest.raises(ValueError):
            write_table(spark.range(1), bucket_by=["id"], buckets=2, **more)
