"""Published results, from retyped rows of the published inputs."""

import datetime

import pytest
from pyspark.sql import functions as F

from burgage.operators import activity, combined, flows, ranking, series

# ---- fixed values: published rows ----

TREND = [
    (2019, "Additions Alterations Or Repairs", 2409), (2019, "Demolitions", 114),
    (2019, "Grade Or Quarry Or Fill Or Excavate", 7), (2019, "New Construction", 47),
    (2019, "New Construction Wood Frame", 89), (2019, "Otc Alterations Permit", 37513),
    (2019, "Sign - Erect", 461), (2019, "Wall Or Painted Sign", 54),
    (2020, "Additions Alterations Or Repairs", 1425), (2020, "Demolitions", 65),
    (2020, "Grade Or Quarry Or Fill Or Excavate", 10), (2020, "New Construction", 39),
    (2020, "New Construction Wood Frame", 41), (2020, "Otc Alterations Permit", 19514),
    (2020, "Sign - Erect", 259), (2020, "Wall Or Painted Sign", 29),
    (2025, "Additions Alterations Or Repairs", 1168), (2025, "Demolitions", 47),
    (2025, "Grade Or Quarry Or Fill Or Excavate", 3), (2025, "New Construction", 10),
    (2025, "New Construction Wood Frame", 45), (2025, "Otc Alterations Permit", 22949),
    (2025, "Sign - Erect", 491), (2025, "Wall Or Painted Sign", 47), (2025, None, 130),
]

INDEX = [
    ("1975-07-01", 18.7), ("1975-10-01", 19.28),
    ("2000-01-01", 158.93), ("2000-04-01", 169.85), ("2000-07-01", 178.53), ("2000-10-01", 184.18),
    ("2025-01-01", 510.19), ("2025-04-01", 510.34), ("2025-07-01", 512.26), ("2025-10-01", 515.73),
]

FLOWS = [
    ("1 Family Dwelling", "2 Family Dwelling", 3111), ("2 Family Dwelling", "Apartments", 1816),
    ("Retail Sales", "Food/Beverage Hndlng", 1723), ("Vacant Lot", "Apartments", 1237),
    ("Apartments", "2 Family Dwelling", 982), ("2 Family Dwelling", "1 Family Dwelling", 874),
    ("Office", "Retail Sales", 680), ("Retail Sales", "Office", 638),
    ("Office", "Food/Beverage Hndlng", 575), ("Vacant Lot", "2 Family Dwelling", 427),
    ("Office", "Apartments", 400), ("Retail Sales", "Apartments", 370),
    ("Vacant Lot", "1 Family Dwelling", 314), ("Vacant Lot", "Office", 284),
    ("1 Family Dwelling", "Apartments", 268),
]

PLACES = [
    ("Financial District/South Beach", 134926), ("Sunset/Parkside", 79130), ("Mission", 78493),
    ("West of Twin Peaks", 66050), ("Marina", 53936),
]


@pytest.fixture(scope="module")
def trend(spark):
    return spark.createDataFrame(TREND, "issued_year long, permit_type string, permit_count long")


@pytest.fixture(scope="module")
def index(spark):
    rows = [(datetime.date.fromisoformat(d), v) for d, v in INDEX]
    return spark.createDataFrame(rows, "observation_date date, hpi_value double")


def test_top_five_types(trend):
    top = ranking.top_categories(trend, "permit_type", 5, "permit_count")
    assert [r.permit_type for r in top.collect()] == [
        "Otc Alterations Permit", "Additions Alterations Or Repairs", "Sign - Erect",
        "Demolitions", "New Construction Wood Frame"]
    assert activity.trend_top_types(trend).count() == 15


def test_yearly_totals_count_missing_types(trend, index):
    got = {r.year: r for r in combined.permits_vs_index(trend, index, years=(2000, 2025)).collect()}
    assert set(got) == {2025}
    assert got[2025].total_permits == 24890 and got[2025].hpi == pytest.approx(512.13)
    means = {r.year: r.hpi for r in combined.yearly_index(index).collect()}
    assert means[2000] == pytest.approx(172.8725) and means[1975] == pytest.approx(18.99)


def test_fall_after_the_peak(trend):
    peak = activity.peak_years(trend).filter("permit_type = 'Otc Alterations Permit'").collect()[0]
    assert (peak.peak_year, peak.peak_count, peak.largest_drop) == (2019, 37513, 19514 - 37513)


def test_series_labels(index):
    got = series.index_series(index).collect()
    assert (got[0].quarter, got[0].hpi_value) == ("1975 Q3", 18.7)
    assert (got[-1].quarter, got[-1].hpi_value) == ("2025 Q4", 515.73)


def test_nodes_of_the_published_flows(spark):
    edges = spark.createDataFrame(FLOWS, "existing_use string, proposed_use string, flow_count long")
    nodes = flows.sankey_nodes(edges).orderBy("node_id").collect()
    assert [n.label for n in nodes] == [
        "1 Family Dwelling", "2 Family Dwelling", "Retail Sales", "Vacant Lot", "Apartments",
        "Office", "Food/Beverage Hndlng"]
    links = flows.sankey_links(edges).orderBy(F.desc("value")).collect()
    assert [tuple(x) for x in links[:3]] == [(0, 1, 3111), (1, 4, 1816), (2, 6, 1723)]
    assert len(links) == 15


def test_five_busiest_places(spark):
    df = spark.createDataFrame(PLACES, "neighborhood string, total_permits long")
    assert df.agg(F.sum("total_permits")).collect()[0][0] == 412535
    bars = ranking.ranked_bar(df, "total_permits", "neighborhood", ascending=True).collect()
    assert [b.neighborhood for b in bars] == [p for p, _ in reversed(PLACES)]
