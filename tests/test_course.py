"""From landed files to exports, in batch and as a stream."""

import datetime
import json
import os
import subprocess
import sys
import uuid
from types import SimpleNamespace

import numpy as np
import pytest

from burgage.operators import cleaning
from burgage.plans import housing
from burgage.schemas import (BUILDING_PERMITS, CENSUS_ACS, CENSUS_VARIABLES, HOUSE_PRICE_INDEX,
                             LAND_USE)
from burgage.session import kept, scratch_path, shared_folder
from burgage.sources import export_all
from burgage.streaming import store_permits


def csv_text(schema, rows):
    names = schema.fieldNames()
    lines = [",".join(n.replace("_", " ").title() for n in names)]
    for row in rows:
        lines.append(",".join('"' + str(row[n]).replace('"', '""') + '"' if n in row else ""
                              for n in names))
    return "\n".join(lines) + "\n"


def permit(i, **more):
    return {"permit_number": f"P{i}", "permit_type_definition": "otc alterations permit",
            "filed_date": "01/02/2019", "issued_date": f"{i % 12 + 1}/3/2019",
            "description": 'new "deck"\nand stairs', "existing_use": "office",
            "proposed_use": "retail sales", "estimated_cost": "100.50",
            "neighborhoods_analysis_boundaries": "Mission", "zipcode": "94110", **more}


@pytest.fixture
def landed(tmp_path):
    permits = [permit(i) for i in range(60)]
    permits += [permit(60, estimated_cost="lots"), permit(61, issued_date="soon")]
    files = {
        "permits": csv_text(BUILDING_PERMITS, permits),
        "land_use": csv_text(LAND_USE, [
            {"the_geom": "POLYGON ((1 1, 2 2))", "blklot": "1", "landuse": "RESIDENT",
             "restype": " FLATS ", "units": "3.0"}, {"blklot": "2", "restype": "LOST"}]),
        "price_index": csv_text(HOUSE_PRICE_INDEX, [
            {"observation_date": "2019-01-01", "value": "300.5"},
            {"observation_date": ".", "value": "1"}]),
        "census": csv_text(CENSUS_ACS, [
            {"name": "T", "median_rent": "2000", "median_income": "90000", "pop_total": "100",
             "pop_white": "25", "state": "06", "county": "075", "tract": "94110", "geoid": "x"},
            {"name": "U", "median_rent": "-666666666", "median_income": "-666666666",
             "pop_total": "0", "pop_white": "0", "tract": "94110"}]),
    }
    paths = {}
    for name, text in files.items():
        folder = tmp_path / "landed" / name
        folder.mkdir(parents=True)
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
        paths[name] = str(folder)
    return paths


def test_course(spark, landed, tmp_path):
    sources = housing.load_sources(spark, landed)
    assert sources["permits"].good.count() == 61
    assert [r.bad_columns for r in sources["permits"].rejects.collect()] == [["estimated_cost"]]
    assert {k: v.count() for k, v in housing.undated(sources).items()} == {"permits": 1, "price_index": 1}
    clean = housing.clean_sources(sources)
    assert clean["permits_clean"].count() == 60 and len(clean["permits_clean"].columns) == 15
    stored = housing.store(spark, clean, str(tmp_path / "stored"))
    assert stored["permits_clean"].schema["estimated_cost"].dataType.simpleString() == "decimal(18,2)"
    views = housing.reports(stored)
    got = {name: [tuple(r) for r in df.collect()] for name, df in views.items()}
    days = [(datetime.date(2019, i % 12 + 1, 3) - datetime.date(2019, 1, 2)).days for i in range(60)]
    kind = "Otc Alterations Permit"
    assert got["quality_summary"] == [(60, 2019, 2019, sum(days) / 60, 1)]
    assert got["permits_trend"] == got["trend_top_types"] == [(2019, kind, 60)]
    assert got["change_of_use"] == [("Office", "Retail Sales", 60)]
    assert got["sankey_nodes"] == [(0, "Office"), (1, "Retail Sales")]
    assert got["sankey_links"] == [(0, 1, 60)]
    assert got["housing_types"] == [("FLATS", 1)]
    assert float(got["neighborhood_activity"][0][3]) == 60 * 100.5
    assert sorted(got["processing_time"]) == sorted((kind, d) for d in days)
    (box,) = got["processing_time_box"]
    assert box[0] == kind and box[1:4] == tuple(np.percentile(days, [25, 50, 75])) and box[4] == 60
    assert got["hpi_series"] == [(datetime.date(2019, 1, 1), 300.5, "2019 Q1")]
    assert got["permits_vs_hpi"] == [(2019, 60, 300.5)]
    assert got["county_stats"] == [("075", 2000.0, 90000.0, 100, 1)]
    marker = views["county_markers"].collect()[0]
    assert (marker.name, marker.rent_text, marker.vmin, marker.vmax) == (
        "San Francisco", "$2,000", 2000.0, 2000.0)
    assert len(got["census_clean"]) == 2
    assert got["neighborhood_income_vs_wait"][0][2:] == (60, 90000.0, 2000.0)
    housing.register_views(stored)
    assert spark.sql("SELECT count(*) AS n FROM permits_clean").collect()[0].n == 60
    paths = export_all(views, str(tmp_path / "out"), single_file=True, orders=housing.orders())
    assert len(paths) == len(views)
    assert spark.read.option("header", True).csv(paths["permits_trend"]).count() == 1
    sample = housing.samples(stored, 10)["processing_time_sample"]
    assert sample.count() == 10 and sample.exceptAll(views["processing_time"]).count() == 0


def test_dates_in_other_formats(spark, landed):
    raw = spark.createDataFrame([("2018/01/05", "05.02.2018"), ("x", "2018/01/06"), ("2018/01/05", "x")],
                                "filed_date string, issued_date string")
    roles = {"filed_date": "filed_date", "issued_date": "issued_date"}
    formats = ["yyyy/MM/dd", "dd.MM.yyyy"]
    got = cleaning.clean_permits(raw, roles, formats=formats).orderBy("issued_date").collect()
    assert [r.processing_days for r in got] == [None, 31]
    assert cleaning.undated_permits(raw, roles, formats=formats).count() == 1


def test_census_from_responses(spark, tmp_path):
    header = [*CENSUS_VARIABLES, "state", "county", "tract"]
    files = {"a.json": [header, ["T1", "2000", "90000", "100", "25", "06", "075", "010100"],
                        ["T2", "-666666666", "many", "0", "0", "06", "075", "010200"]],
             "b.json": [header[::-1], ["020100", "001", "06", "5", "10", "1", "2", "T3"]]}
    for name, table in files.items():
        (tmp_path / name).write_text(json.dumps(table))
    (tmp_path / "c.json").write_text("error: try again later")
    census = housing.load_census_responses(spark, str(tmp_path))
    assert sorted((r.name, r.median_rent, r.geoid) for r in census.good.collect()) == [
        ("T1", 2000, "06075010100"), ("T3", 2, "06001020100")]
    assert [r.bad_columns for r in census.rejects.collect()] == [["median_income"]]
    assert [r.path.rpartition("/")[2] for r in census.responses.collect()] == ["c.json"]


def test_stream_equals_batch(spark, landed, tmp_path):
    out, checkpoint = str(tmp_path / "tables"), str(tmp_path / "checkpoint")

    def run():
        for query in store_permits(spark, landed["permits"], out, checkpoint).values():
            assert query.awaitTermination(120)
        return {name: spark.read.parquet(f"{out}/{name}") for name in ("permits", "rejects", "undated")}

    def same(a, b):
        return a.count() == b.count() and a.exceptAll(b.select(a.columns)).isEmpty() \
            and b.select(a.columns).exceptAll(a).isEmpty()

    def equals_batch(stored):
        typed = housing.load_sources(spark, {"permits": landed["permits"]})["permits"]
        return (same(stored["permits"], cleaning.clean_permits(typed.good))
                and same(stored["rejects"], typed.rejects)
                and same(stored["undated"], cleaning.undated_permits(typed.good)))

    stored = run()
    assert [df.count() for df in stored.values()] == [60, 1, 1] and equals_batch(stored)
    assert [df.count() for df in run().values()] == [60, 1, 1]  # nothing new
    with open(f"{landed['permits']}/more.csv", "w", encoding="utf-8") as f:
        f.write(csv_text(BUILDING_PERMITS, [permit(99), permit(98, estimated_cost="?")]))
    stored = run()
    assert [df.count() for df in stored.values()] == [61, 2, 1] and equals_batch(stored)


def test_kept_while_in_use(spark):
    df = spark.range(100)
    with kept(df) as same:
        assert same.storageLevel.useMemory and same.count() == 100
    assert not df.storageLevel.useMemory


def test_scratch_folder(spark):
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first != second and first.startswith(shared_folder(spark))


def test_no_machine_local_folder_on_a_cluster():
    def session(master, **conf):
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    warehouse = {"spark.sql.warehouse.dir": "file:/home/x/warehouse"}
    for place in ("file:/home/x/warehouse", "/home/x/warehouse"):
        with pytest.raises(ValueError):
            shared_folder(session("spark://host:7077", **{"spark.sql.warehouse.dir": place}))
    assert shared_folder(session("local[2]", **warehouse)) == "file:/home/x/warehouse/_scratch"
    assert shared_folder(session("yarn", **warehouse, **{"spark.checkpoint.dir": "hdfs://n/c"})) == "hdfs://n/c"
    assert shared_folder(session("yarn", **{"spark.sql.warehouse.dir": "hdfs://n/w/"})) == "hdfs://n/w/_scratch"


CHILD = """
import sys
sys.path.insert(0, {root!r})
from burgage.session import get_session, scratch_path, shared_folder, written
spark = get_session("scratch", master="local[1]", spark__ui__enabled="false",
                    spark__sql__warehouse__dir={folder!r}{more})
import os
place = shared_folder(spark).removeprefix("file:")
before = set(os.listdir(place)) if os.path.isdir(place) else set()
assert written(spark.range(5), "five").count() == 5
mine = [f for f in set(os.listdir(place)) - before if f.startswith(spark.sparkContext.applicationId)]
print("made", place, *mine)
spark.stop()
"""


@pytest.mark.parametrize("named", [False, True])
def test_nothing_is_left_behind(tmp_path, named):
    """What was written goes when the application ends, wherever the shared folder is."""
    folder, root = str(tmp_path / "warehouse"), os.path.dirname(os.path.dirname(__file__))
    shared = str(tmp_path / "shared") if named else f"{folder}/_scratch"
    more = f", spark__checkpoint__dir={shared!r}" if named else ""
    out = subprocess.run([sys.executable, "-c", CHILD.format(root=root, folder=folder, more=more)],
                         capture_output=True, text=True, timeout=120)
    made = out.stdout.strip().splitlines()[-1].split() if out.stdout.strip() else []
    assert made[:1] == ["made"] and len(made) == 3, out.stderr[-2000:]
    assert not named or made[1] == shared
    # The application's folder is gone. Where the setting names a folder, Spark makes one of its own
    # for checkpoints there, and leaves it, empty.
    assert made[2] not in (os.listdir(made[1]) if os.path.isdir(made[1]) else [])
    left = os.listdir(shared) if named else []
    assert len(left) == (1 if named else 0)
    assert all(uuid.UUID(f) and os.listdir(os.path.join(shared, f)) == [] for f in left)
