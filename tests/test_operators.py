import datetime
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from burgage.operators import activity, cleaning, combined, flows, quantiles, ranking, regions
from burgage.operators import profile as profiles
from burgage.operators import series, timing


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ---- cleaning ----

def raw_permits(spark):
    fields = list(cleaning.PERMIT_ROLES.values())
    base = dict.fromkeys(fields)

    def one(number, filed, issued):
        return tuple({**base, "permit_number": number, "permit_type_definition": "otc ALTERATIONS",
                      "filed_date": filed, "issued_date": issued}[f] for f in fields)

    data = [one("same", "1/1/2020", "1/1/2020"), one("neg", "1/2/2020", "1/1/2020"),
            one("k", "1/1/2020", "9/27/2022"), one("k1", "1/1/2020", "9/28/2022"),
            one("nofile", None, "1/1/2020"), one("badfile", "soon", "1/1/2020"),
            one("noissue", "1/1/2020", None), one("badissue", "1/1/2020", "13/45/2020")]
    return spark.createDataFrame(data, ", ".join(f"{f} string" for f in fields))


def test_clean_permits_keeps_odd_days(spark):
    got = {r.permit_number: r for r in cleaning.clean_permits(raw_permits(spark)).collect()}
    assert {k: r.processing_days for k, r in got.items()} == {
        "same": 0, "neg": -1, "k": 1000, "k1": 1001, "nofile": None, "badfile": None}
    assert got["k"].permit_type == "Otc Alterations" and got["k"].issued_year == 2022
    assert len(got["k"]) == 15


def test_clean_permits_narrow(spark):
    df = cleaning.clean_permits(raw_permits(spark), cleaning.NARROW_PERMIT_ROLES,
                                days_range=(0, 1000), date_suffix="_ts")
    assert sorted(r.permit_number for r in df.collect()) == ["k", "same"]
    assert sorted(df.columns) == sorted([
        "permit_number", "permit_type", "filed_date_ts", "issued_date_ts", "issued_year",
        "processing_days", "existing_use", "proposed_use", "estimated_cost", "neighborhood",
        "zipcode"])


def test_clean_census_and_geoid(spark):
    raw = spark.createDataFrame(
        [("a", 100, -666666666, 200, 50, "06", "001", "1"), ("b", -666666666, 5, 0, 0, "06", None, "2")],
        "name string, median_rent long, median_income long, pop_total long, pop_white long, "
        "state string, county string, tract string")
    got = rows(cleaning.clean_census(cleaning.with_geoid(raw)), "tract_name")
    assert got == [("a", "060011", "06", "001", "1", 100, None, 200, 50, 25.0),
                   ("b", None, "06", None, "2", None, 5, 0, 0, None)]


def test_clean_land_use_and_index(spark):
    raw = spark.createDataFrame([("r", " FLAT "), (None, "x"), ("m", None), ("m", "  ")],
                                "landuse string, restype string")
    clean = cleaning.clean_land_use(raw, keep=())
    assert Counter(rows(clean)) == Counter([("r", "FLAT"), ("m", None), ("m", "")])
    assert rows(activity.category_counts(clean, "restype")) == [("FLAT", 1)]
    index = spark.createDataFrame([("2020-01-01", 1.5), ("x", 2.0)], "observation_date string, value double")
    assert rows(cleaning.clean_price_index(index)) == [(datetime.date(2020, 1, 1), 1.5)]


# ---- ranking ----

def test_places_ranked_ties_and_gaps(spark):
    data = ([("a", 2018)] * 3 + [("b", 2018)] * 3 + [("c", 2018)] + [("a", 2020)] * 5
            + [("b", 2019)] + [(None, 2018)] * 9 + [("a", 2017)] * 7 + [("a", 2025)])
    df = spark.createDataFrame(data, "neighborhood string, issued_year long")
    assert rows(activity.places_ranked(df), F.desc("issued_year"), "rank_in_year", "neighborhood") == [
        ("a", 2020, 5, 1, 2), ("b", 2019, 1, 1, -2),
        ("a", 2018, 3, 1, None), ("b", 2018, 3, 1, None), ("c", 2018, 1, 3, None)]


def test_rank_within_equals_rank(spark):
    rng = random.Random(1)
    data = [(rng.choice(["x", "y", None]), rng.choice([1, 2, 3, 4, None]), i) for i in range(300)]
    df = spark.createDataFrame(data, "g string, s long, i long")
    from pyspark.sql import Window as W
    expected = df.withColumn("rank", F.rank().over(W.partitionBy("g").orderBy(F.desc("s"))))
    got = ranking.rank_within(df, ["g"], "s")
    assert Counter(rows(got.select("g", "s", "i", "rank"))) == \
        Counter(rows(expected.select("g", "s", "i", "rank")))


def test_top_categories(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("b", 2.0), ("c", None), (None, 99.0)],
                               "t string, w double")
    assert rows(ranking.top_categories(df, "t", 3, "w")) == [("a", 5.0), ("b", 5.0), ("c", 0.0)]
    assert rows(ranking.top_categories(df, "t", 1)) == [("b", 2)]
    assert Counter(rows(ranking.keep_top_categories(df, "t", 1).select("t", "w"))) == \
        Counter([("b", 3.0), ("b", 2.0)])
    assert Counter(rows(ranking.value_counts(df, "t"))) == Counter([("a", 1), ("b", 2), ("c", 1)])


def test_share_sums_to_one(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "t string, n long")
    assert rows(ranking.with_share(df, "n"), "t") == [("a", 1, 0.25), ("b", 3, 0.75)]
    assert rows(ranking.with_share(df.filter("false"), "n")) == []


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000).withColumn("x", F.col("id") * 2)
    first = ranking.sample_rows(df, 700, ["id"])
    again = ranking.sample_rows(df.repartition(13), 700, ["id"])
    assert first.count() == 700 and set(rows(first)) == set(rows(again))
    assert first.columns == ["id", "x"]
    expected = df.orderBy(F.md5(F.concat_ws("~", F.col("id").cast("string"), F.lit("42"))
                                .cast("binary"))).limit(700)
    assert set(rows(first)) == set(rows(expected))
    assert ranking.sample_rows(df, 9999, ["id"]).count() == 5000
    assert set(rows(ranking.sample_rows(df, 700, ["id"], seed=7))) != set(rows(first))
    assert ranking.sample_rows(df.filter("false"), 5, ["id"]).count() == 0


def test_ranked_bar(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "t string, n long")
    assert [r.t for r in ranking.ranked_bar(df, "n", "t").collect()] == ["c", "a", "b"]
    assert [r.t for r in ranking.ranked_bar(df, "n", "t", True).collect()] == ["a", "b", "c"]


# ---- quantiles ----

VALUE_SETS = {
    "mixed": lambda r: r.choice([0.0, -1.5, 1e300, -1e-300, 3.25, 10.0, 9.999999999, 100.0, -100.0]),
    "cents": lambda r: round(r.uniform(-999, 99999), 2),
    "same": lambda r: 7.5,
    "narrow": lambda r: 1234567.0 + r.random() / 1e5,
    "powers": lambda r: 10.0 ** r.randint(-12, 12) * r.choice([1, -1]),
    "infinite": lambda r: r.choice([float("inf"), 1.0, 2.0, 3.0, 4.0, 5.0]),
}


@pytest.mark.parametrize("kind", VALUE_SETS)
def test_quantiles_equal_sorting(spark, kind):
    rng = random.Random(kind)
    groups = {"a": 1, "b": 2, "c": 7, None: 400}
    data = [(g, VALUE_SETS[kind](rng)) for g, n in groups.items() for _ in range(n)]
    df = spark.createDataFrame(data + [("a", None), ("b", float("nan")), ("empty", None)],
                               "g string, v double")
    probs = [0.0, 0.1, 0.5, 0.73, 1.0]
    got = {r[0]: r[1:] for r in quantiles.exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert set(got) == set(groups)
    for g in groups:
        values = sorted(v for k, v in data if k == g)
        for p, x in zip(probs, got[g]):
            at = p * (len(values) - 1)
            lo, hi = values[int(np.floor(at))], values[int(np.ceil(at))]
            want = lo if lo == hi else lo * (1 - at % 1) + hi * (at % 1)
            assert x == want or abs(x - want) <= 1e-9 * abs(want) or (x != x and want != want)


def test_quantiles_without_keys_and_of_integers(spark):
    df = spark.range(1, 102)
    assert rows(quantiles.exact_quantiles(df, "id", [0.5, 0.1], names=["m", "t"])) == [(51.0, 11.0)]
    assert rows(quantiles.exact_quantiles(df.filter("false"), "id", [0.5])) == [(None,)]


def test_nothing_runs_while_quantiles_are_built(spark):
    seen = []
    group = "quantiles-built"
    spark.sparkContext.setJobGroup(group, group)
    try:
        df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
        quantiles.exact_quantiles(df, "v", [0.5], ["g"])
        timing.box_summary(df, "v", "g")
        regions.colour_bounds(df, rent="v")
        regions.county_stats(df.select(*[F.col("v").alias(c) for c in (
            "county", "median_rent", "median_income", "pop_total", "tract")]))
        seen = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(seen) == []


def test_close_values_end_in_small_bins(spark):
    """Values that share their leading digits are told apart by the further rounds."""
    df = spark.range(200_000).select(F.lit("a").alias("_g"), (F.lit(1.6e15) + F.col("id") * 7).alias("_v"),
                                     F.lit(1).cast("bigint").alias("_n"))
    spots = quantiles._positions([0.25, 0.5, 0.9])
    near, path = quantiles._narrowed(df, ["_g"], spots)
    assert max(r["count"] for r in near.groupBy(*path).count().collect()) <= 4
    got = quantiles.quantiles_of_counts(df, "_v", "_n", [0.25, 0.5, 0.9], ["_g"]).collect()[0]
    assert list(got)[1:] == [1.6e15 + 7 * q * 199_999 for q in (0.25, 0.5, 0.9)]


def test_an_outlier_does_not_widen_the_bins(spark):
    """A million distinct times within a second, and one a day later."""
    times = spark.range(1_000_000).select((F.lit(1_700_000_000_000_000) + F.col("id")).alias("_v")).union(
        spark.sql("SELECT 1700086400000000L"))
    df = times.select(F.lit("a").alias("_g"), "_v", F.lit(1).cast("bigint").alias("_n"))
    near, path = quantiles._narrowed(df, ["_g"], quantiles._positions([0.5]))
    assert max(r["count"] for r in near.groupBy(*path).count().collect()) <= 64
    got = quantiles.quantiles_of_counts(df, "_v", "_n", [0.5, 1.0], ["_g"]).collect()[0]
    assert list(got)[1:] == [1_700_000_000_500_000.0, 1_700_086_400_000_000.0]


def test_codes_rise_with_the_value(spark):
    """They are the bits of the double, so no two values share one."""
    rng = np.random.default_rng(7)
    bits = np.concatenate([rng.integers(0, 2047 << 52, 3000), np.arange(5), (np.arange(1, 2047) << 52),
                           (np.arange(1, 2047) << 52) - 1, [2047 << 52]]).astype(np.int64)
    values = np.concatenate([bits.view(np.float64), -bits.view(np.float64)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = np.array([r[0] for r in df.select(quantiles._code(F.col("v"))).collect()])
    assert (got == np.concatenate([bits, -bits])).all()


def test_extreme_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(-inf,), (-1e308,), (0.0,), (5e-324,), (1e308,), (inf,), (inf,)], "v double")
    assert rows(quantiles.exact_quantiles(df, "v", [0.0, 0.5, 1.0])) == [(-inf, 5e-324, inf)]


def test_medians_of_several_columns(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", None, 4), ("c", None, None)],
                               "g string, x long, y long")
    assert rows(quantiles.medians(df, ["x", "y"], ["g"]), "g") == [("a", 1.5, None), ("b", None, 4.0)]


# ---- timing ----

def test_processing_stats(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 9), ("a", None), ("b", None), (None, 4)],
                               "permit_type string, processing_days long")
    assert rows(timing.processing_stats(df), F.asc_nulls_last("permit_type")) == [
        ("a", 4, 4.0, 2.0, 1, 9), ("b", 1, None, None, None, None), (None, 1, 4.0, 4.0, 4, 4)]
    approx = rows(timing.processing_stats(df, approx=True), F.asc_nulls_last("permit_type"))
    assert approx[0] == ("a", 4, 4.0, 2.0, 1, 9)


def test_processing_time_bounds(spark):
    df = spark.createDataFrame([("a", d) for d in (-1, 0, 1000, 1001, None)],
                               "permit_type string, processing_days long")
    assert sorted(rows(timing.processing_time(df))) == [("a", 0), ("a", 1000)]


@pytest.mark.parametrize("bounded", [True, False])
def test_box_summary(spark, bounded):
    data = [("a", v) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]] + [("b", 5)] * 3 + [(None, 1)] * 20
    df = spark.createDataFrame(data, "t string, v long")
    got = rows(timing.box_summary(df, "v", "t", bounded_values=bounded), "t")
    assert got == [("a", 3.0, 5.0, 7.0, 9, 1, 8, 1), ("b", 5.0, 5.0, 5.0, 3, 5, 5, 0)]
    assert [r[0] for r in rows(timing.box_summary(df, "v", "t", k=1, bounded_values=bounded))] == ["a"]


# ---- counts ----

def test_trend_and_its_top_types(spark):
    df = spark.createDataFrame([("x", 2000)] * 3 + [(None, 2001)] * 5 + [("y", 1999)] + [("y", 2024)],
                               "permit_type string, issued_year long")
    counts = activity.trend(df)
    assert Counter(rows(counts)) == Counter([(2000, "x", 3), (2001, None, 5), (2024, "y", 1)])
    top = activity.trend_top_types(counts, 1).select("issued_year", "permit_type", "permit_count")
    assert rows(top) == [(2000, "x", 3)]
    assert Counter(rows(combined.yearly_totals(counts))) == Counter([(2000, 3), (2001, 5), (2024, 1)])


def test_quality_summary(spark):
    df = spark.createDataFrame([(2000, 10, "a"), (2003, None, "a"), (2001, 5, None)],
                               "issued_year long, processing_days long, neighborhood string")
    assert rows(activity.quality_summary(df)) == [(3, 2000, 2003, 7.5, 1)]
    assert rows(activity.quality_summary(df.filter("false"))) == [(0, None, None, None, 0)]


def test_place_activity(spark):
    df = spark.createDataFrame([("b", 1, 5), ("b", 2, 6), ("a", None, 1), ("c", 3, 1), (None, 9, 9)],
                               "neighborhood string, processing_days long, estimated_cost long")
    assert rows(activity.place_activity(df, 2)) == [("b", 2, 1.5, 11), ("a", 1, None, 1)]
    assert activity.place_activity(df, None, cost=None).columns == [
        "neighborhood", "total_permits", "avg_processing_days"]


def test_peak_years(spark):
    df = spark.createDataFrame([("a", 2000, 5), ("a", 2001, 9), ("a", 2003, 9), ("a", 2004, 2), ("b", 2000, 1)],
                               "permit_type string, issued_year long, permit_count long")
    assert rows(activity.peak_years(df), "permit_type") == [("a", 2001, 9, -7), ("b", 2000, 1, None)]


# ---- flows ----

def test_change_of_use_before_and_after(spark):
    data = ([("office", "OFFICE")] * 3 + [("Office", "retail")] * 2 + [("OFFICE", "Retail")] * 2
            + [("x", "x")] * 9 + [(None, "x"), ("x", None)])
    df = spark.createDataFrame(data, "existing_use string, proposed_use string")
    assert Counter(rows(flows.change_of_use(df))) == Counter(
        [("Office", "Office", 3), ("Office", "Retail", 2), ("Office", "Retail", 2)])
    assert rows(flows.change_of_use(df, normalise="before")) == [
        ("Office", "Retail", 4), ("Office", "Office", 3)]
    assert len(rows(flows.change_of_use(df, 1))) == 1
    with pytest.raises(ValueError):
        flows.change_of_use(df, normalise="never")


def test_sankey_nodes_are_shared(spark):
    edges = spark.createDataFrame([("b", "c", 9), ("a", "b", 5), ("b", "d", 7), ("c", "c", 1)],
                                  "existing_use string, proposed_use string, flow_count long")
    assert rows(flows.sankey_nodes(edges), "node_id") == [(0, "b"), (1, "a"), (2, "c"), (3, "d")]
    assert Counter(rows(flows.sankey_links(edges))) == Counter(
        [(0, 2, 9), (0, 3, 7), (1, 0, 5), (2, 2, 1)])
    assert rows(flows.sankey_nodes(edges, 1), "node_id") == [(0, "b"), (1, "c")]


def test_all_edges_are_numbered(spark):
    rng = random.Random(3)
    pairs = {(f"s{rng.randint(0, 30)}", f"t{rng.randint(0, 30)}") for _ in range(300)}
    edges = [(s, t, rng.randint(1, 5)) for s, t in sorted(pairs)]
    df = spark.createDataFrame(edges, "existing_use string, proposed_use string, flow_count long")
    ordered = sorted(edges, key=lambda e: (-e[2], e[0], e[1]))
    labels = list(dict.fromkeys([e[0] for e in ordered] + [e[1] for e in ordered]))
    assert rows(flows.sankey_nodes(df), "node_id") == list(enumerate(labels))
    at = {x: i for i, x in enumerate(labels)}
    assert Counter(rows(flows.sankey_links(df))) == Counter((at[s], at[t], n) for s, t, n in edges)


def test_stats_of_free_values(spark):
    rng = random.Random(9)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, rng.random() * 100])) for _ in range(500)]
    df = spark.createDataFrame(data + [("c", None)], "permit_type string, processing_days double")
    assert rows(timing.processing_stats(df, whole_days=False).orderBy("permit_type")) == rows(
        timing.processing_stats(df).orderBy("permit_type"))


# ---- two tables ----

@pytest.mark.parametrize("keep", [False, True])
def test_income_vs_wait_equals_the_pairs(spark, keep):
    rng = random.Random(5)
    permits = [(rng.choice(["p", "q", "r", None]), rng.choice(["1", "2", "3", "4", None]),
                rng.choice([None, -5, 0, 10, 500, 1000, 1001])) for _ in range(400)]
    tracts = [(rng.choice(["1", "2", "3", None]), rng.choice([None, -1, 0, 100, 900]),
               rng.choice([None, 10, 20])) for _ in range(12)]
    groups = defaultdict(list)
    for place, key, days in permits:
        if place is None or days is None or not 0 <= days <= 1000:
            continue
        hits = [(i, r) for t, i, r in tracts if t is not None and t == key and i and i > 0]
        for pair in hits or ([(None, None)] if keep else []):
            groups[place].append((days, *pair))

    def mean(values, digits=None):
        values = [v for v in values if v is not None]
        if not values:
            return None
        m = sum(values) / len(values)
        return m if digits is None else float(np.floor(m + 0.5))

    want = {p: (mean([x[0] for x in g]), len(g), mean([x[1] for x in g], 0), mean([x[2] for x in g], 0))
            for p, g in groups.items() if len(g) >= 20}
    got = combined.income_vs_wait(
        spark.createDataFrame(permits, "neighborhood string, zipcode string, processing_days long"),
        spark.createDataFrame(tracts, "tract string, median_income long, median_rent long"),
        min_pairs=20, keep_unmatched=keep)
    found = {r[0]: tuple(r[1:]) for r in got.collect()}
    assert set(found) == set(want)
    for place in want:
        assert found[place] == pytest.approx(want[place])


def test_income_vs_wait_threshold(spark):
    permits = spark.createDataFrame([("a", "1", 5)] * 49 + [("b", "1", 5)] * 50,
                                    "neighborhood string, zipcode string, processing_days long")
    tract = spark.createDataFrame([("1", 10, None)], "tract string, median_income long, median_rent long")
    report = combined.income_vs_wait(permits, tract)
    assert rows(report) == [("b", 5.0, 50, 10.0, None)]
    assert rows(combined.income_wait_scatter(report)) == [("b", 10.0, 5.0, 50, None)]


def test_permits_vs_index(spark):
    counts = spark.createDataFrame([(2000, "x", 3), (2000, None, 4), (1999, "x", 1), (2001, "x", 2), (None, "x", 8)],
                                   "issued_year long, permit_type string, permit_count long")
    index = spark.createDataFrame([(datetime.date(2000, 1, 1), 10.0), (datetime.date(2000, 4, 1), 20.0),
                                   (datetime.date(1999, 4, 1), 1.0)],
                                  "observation_date date, hpi_value double")
    assert rows(combined.permits_vs_index(counts, index)) == [(2000, 7, 15.0)]


# ---- regions and series ----

def tract_rows(spark):
    return spark.createDataFrame(
        [("001", "1", 100, 10, 5), ("001", "2", 300, None, 6), ("001", "3", None, 30, 7),
         ("075", "4", 50, 50, None), ("999", "5", 1, 1, 900000), (None, "6", 1, 1, 1)],
        "county string, tract string, median_rent long, median_income long, pop_total long")


def test_county_stats(spark):
    df = tract_rows(spark)
    assert rows(regions.county_stats(df), "county") == [
        ("001", 200.0, 10.0, 11, 2), ("075", 50.0, 50.0, 0, 1), ("999", 1.0, 1.0, 900000, 1)]
    text = spark.createDataFrame(
        [("1", "100", "x", "5"), ("001", "bad", "30", "7"), ("1234", "NaN", None, None)],
        "COUNTY_CODE string, Rent string, Income string, POP_TOTAL string")
    got = regions.county_stats(
        text, county=regions.find_column(text, "county"), rent=regions.find_column(text, "rent"),
        income=regions.find_column(text, "income"),
        population=regions.find_column(text, "pop_total"), drop_missing_rent=False, fill_code=True)
    assert rows(got, "county") == [("001", 100.0, 30.0, 12.0, 2), ("1234", None, None, 0.0, 1)]
    with pytest.raises(KeyError):
        regions.find_column(text, "area")


def test_county_markers(spark):
    df = tract_rows(spark)
    stats = regions.county_stats(df)
    got = {r.county: r for r in regions.county_markers(stats, regions.colour_bounds(df)).collect()}
    assert set(got) == {"001", "075"}
    assert (got["001"].name, got["001"].radius, got["001"].rent_text) == ("Alameda", 8.0, "$200")
    want = tuple(np.quantile([100, 300, 50, 1, 1], [0.1, 0.9]))
    assert (got["001"].vmin, got["001"].vmax) == pytest.approx(want)
    fixed = regions.county_markers(stats, digits=2).filter("county = '075'").collect()[0]
    assert (fixed.lat, fixed.lon, fixed.vmin, fixed.vmax) == (37.77, -122.42, 1200.0, 3000.0)


def test_attach_areas(spark):
    areas = spark.createDataFrame([("g1",), ("g2",)], "geoid string")
    stats = spark.createDataFrame([("g1", 5)], "geoid string, median_rent long")
    assert rows(regions.attach_areas(areas, stats), "geoid") == [("g1", 5), ("g2", None)]


def test_index_series(spark):
    df = spark.createDataFrame([(datetime.date(2020, 4, 1), 2.0), (datetime.date(2019, 12, 1), 1.0)],
                               "observation_date date, hpi_value double")
    assert rows(series.index_series(df)) == [
        (datetime.date(2019, 12, 1), 1.0, "2019 Q4"), (datetime.date(2020, 4, 1), 2.0, "2020 Q2")]


def test_profile(spark):
    df = spark.range(10, numPartitions=4).withColumn("b", F.lit(1))
    assert rows(profiles.profile({"t": df})) == [("t", 10, 2)]
    assert rows(profiles.profile({"t": df, "u": df}, partitions=True)) == [
        ("t", 10, 2, 4), ("u", 10, 2, 4)]
    assert rows(profiles.describe_columns(df)) == [(0, "id", "bigint"), (1, "b", "int")]
    assert profiles.by_position(df, "first").columns == ["first", "b"]
