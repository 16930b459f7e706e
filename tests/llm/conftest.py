import json

import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Make a table from rows and a schema, over a few partitions."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(3)
    return make


@pytest.fixture(scope="session")
def words():
    """Invented words that differ by number."""
    def make(first, n):
        return [f"w{i}" for i in range(first, first + n)]
    return make


def pytest_assertrepr_compare(op, left, right):
    if op == "==" and isinstance(left, list) and len(left) > 50:
        return [json.dumps([str(x) for x in left[:5]]), json.dumps([str(x) for x in right[:5]])]
