"""Points in areas against a plain ray test."""

import random

import pytest
from pyspark.sql import functions as F

from burgage.operators.areas import area_cells, edges, points_in_areas


def crossings(rings, x, y):
    n = 0
    for ring in rings:
        closed = ring + ring[:1]
        for (x1, y1), (x2, y2) in zip(closed, closed[1:]):
            n += (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return n


def wkt(rings, closed=True):
    return "POLYGON (" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in (r + r[:1] if closed else r)) + ")" for r in rings) + ")"


def star(rng, x, y, size, corners):
    from math import cos, pi, sin
    return [(x + cos(2 * pi * i / corners) * size * rng.uniform(0.3, 1), y + sin(2 * pi * i / corners) * size * rng.uniform(0.3, 1))
            for i in range(corners)]


@pytest.mark.parametrize("cell", [0.7, 3.0, 50.0])
def test_equals_a_plain_test(spark, cell):
    rng = random.Random(5)
    shapes = {i: [star(rng, rng.uniform(-20, 20), rng.uniform(-20, 20), rng.uniform(0.2, 12), rng.randint(3, 15))] for i in range(25)}
    shapes[100] = [[(-30.0, -30.0), (30.0, -30.0), (30.0, 30.0), (-30.0, 30.0)], [(-5.0, -5.0), (5.0, -5.0), (5.0, 5.0), (-5.0, 5.0)]]
    shapes[101] = [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]]
    shapes[102] = [[(10.0, 0.0), (20.0, 0.0), (20.0, 10.0), (10.0, 10.0)]]
    points = [(i, rng.uniform(-35, 35), rng.uniform(-35, 35)) for i in range(400)]
    points += [(1000 + i, float(x), float(y)) for i, (x, y) in enumerate((x, y) for x in (0, 5, 10, 20) for y in (-5, 0, 5, 10))]
    points += [(2000, None, 1.0), (2001, float("nan"), 1.0), (2002, 1e300, 0.0)]
    areas = spark.createDataFrame([(i, wkt(r, i % 2 == 0)) for i, r in shapes.items()] + [(500, None), (501, ""), (502, "POLYGON EMPTY"), (
        503, "POLYGON ((a b, 1 2, 3 4))")], "id long, geom string")
    table = spark.createDataFrame(points, "p long, x double, y double")
    got = {(r.p, r.area) for r in points_in_areas(table, areas, x="x", y="y", area_id="id", wkt="geom", cell=cell).collect()}
    want = {(p, i) for p, x, y in points if x is not None and abs(x) < 1e6 for i, r in shapes.items() if crossings(r, x, y) % 2}
    assert got - {g for g in got if g[1] == 503} == want


def test_a_shared_border_belongs_to_one(spark):
    areas = spark.createDataFrame([(1, "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"), (2, "POLYGON ((4 0, 8 0, 8 4, 4 4, 4 0))")], "id long, g string")
    points = spark.createDataFrame([(4.0, 2.0), (0.0, 0.0), (4.0, 4.0), (6.0, 0.0)], "x double, y double")
    rows = points_in_areas(points, areas, x="x", y="y", area_id="id", wkt="g", cell=1.0, name="n").collect()
    assert sorted((r.x, r.y, r.n) for r in rows) == [(0.0, 0.0, 1), (4.0, 2.0, 2), (6.0, 0.0, 2)]


def test_most_cells_need_no_test(spark):
    areas = spark.createDataFrame([(1, "MULTIPOLYGON (((0 0, 100 0, 100 100, 0 100, 0 0)))")], "id long, g string")
    cells = area_cells(areas, "id", "g", 1.0)
    assert cells.where("_edges is null").count() > 9_500
    assert areas.select(F.size(edges(F.col("g")))).first()[0] == 5  # a closed ring's last edge has no length


def test_plan_is_an_equi_join(spark):
    areas = spark.createDataFrame([(1, "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))")], "id long, g string")
    points = spark.range(10).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"))
    text = points_in_areas(points, areas, x="x", y="y", area_id="id", wkt="g", cell=1.0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "NestedLoop" not in text and "Cartesian" not in text


def test_small_tables_with_many_pairs_are_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr("burgage.operators.areas.PIECE_POINTS", 50)
    squares = [(i, f"POLYGON (({i} {i}, {i + 4} {i}, {i + 4} {i + 4}, {i} {i + 4}))") for i in range(4)]
    areas = spark.createDataFrame(squares, "id long, g string").coalesce(1)
    points = spark.range(0, 1000, 1, 1).select("id", (F.col("id") % 40 / 10).alias("x"), (F.col("id") % 30 / 10).alias("y"))
    met = points_in_areas(points.withColumnRenamed("id", "p"), areas, x="x", y="y", area_id="id", wkt="g", cell=10.0)
    busy = met.select(F.spark_partition_id().alias("task")).distinct().count()  # all points lie in one cell
    want = sum(i <= p % 40 / 10 < i + 4 and i <= p % 30 / 10 < i + 4 for p in range(1000) for i in range(4))
    assert met.count() == want and met.distinct().count() == want
    assert busy > 1
