"""Every registered report against its SQL, on two sizes."""

import pytest
from oracle import TESTDATA, compare, connect

import __spark_entry__ as entry
from burgage.plans.bindings import TABLES
from burgage.plans.catalog import QUERIES
from burgage.plans.oracle import ORACLE_SQL as SQL


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def size(request):
    sf_dir = f"{TESTDATA}/{request.param}"
    con = connect(sf_dir, TABLES)
    yield sf_dir, con
    con.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_report_equals_sql(spark, size, name):
    sf_dir, con = size
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_report_without_sql_has_rows(spark, size, name):
    assert QUERIES[name](spark, size[0]).count() > 0


def test_every_sql_has_a_report():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["neighborhood", "issued_year", "permit_count", "rank_in_year",
                          "yoy_change"]
    assert df.count() > 0
