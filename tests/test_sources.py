import json

import pytest
from pyspark.sql import functions as F

from burgage.schemas import BUILDING_PERMITS, CENSUS_ACS, LAND_USE, layout
from burgage.sources import (decode_json_table, export_all, export_csv, export_one_csv, list_landed, read_csv,
                             read_csv_inferred, read_json_tables, register_view, rejected_responses,
                             sinks, type_columns, write_table)

SHAPE = layout("id:long name cost:money rate:double")


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_layouts_have_their_widths():
    assert [len(s) for s in (BUILDING_PERMITS, LAND_USE, CENSUS_ACS)] == [43, 23, 9]


def test_tokens_ragged_rows_and_rejects(spark, tmp_path):
    path = write(tmp_path / "a.csv", "\n".join([
        "Any,Header,At,All", "1,ann,10.25,0.5", "2,NULL,NA,null", "3", '4,"x, ""y""",7,1,extra,more',
        "five,bad,1,1", "6,bad cost,1o,1", "7,,,NaN", "8,both,q,w"]))
    raw = read_csv(spark, path, SHAPE)
    good, rejects = type_columns(raw, SHAPE)
    rows = {r.id: (r.name, None if r.cost is None else float(r.cost), r.rate)
            for r in good.collect()}
    assert rows == {1: ("ann", 10.25, 0.5), 2: (None, None, None), 3: (None, None, None),
                    4: ('x, "y"', 7.0, 1.0)}
    assert {r.id: r.bad_columns for r in rejects.collect()} == {
        "five": ["id"], "6": ["cost"], "7": ["rate"], "8": ["cost", "rate"]}
    # neither pruning nor counting changes what counts as bad
    assert good.count() == 4 and good.select("name").count() == 4 and rejects.count() == 4


def test_text_only_layout_has_no_rejects(spark, tmp_path):
    path = write(tmp_path / "a.csv", "h\nx\n")
    good, rejects = type_columns(read_csv(spark, path, layout("a")), layout("a"))
    assert good.collect()[0].a == "x" and rejects.count() == 0


def test_header_goes_once_per_file(spark, tmp_path):
    for i in (1, 2):
        write(tmp_path / f"{i}.csv", f"id,name\n{i},n{i}\n")
    shape = layout("id:long name")
    assert type_columns(read_csv(spark, str(tmp_path), shape), shape).good.count() == 2


def test_multiline_quotes(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'Issued Date,Note\n1/5/2018,"two\nlines, ""quoted"""\n')
    shape = layout("issued note")
    assert read_csv(spark, path, shape, multiline=True).collect() == \
        [("1/5/2018", 'two\nlines, "quoted"')]
    inferred = read_csv_inferred(spark, path, multiline=True, clean_names=True)
    assert inferred.columns == ["issued_date", "note"] and inferred.count() == 1


def test_json_tables_follow_their_own_header(spark, tmp_path):
    write(tmp_path / "1.json", json.dumps([["NAME", "RENT", "tract"], ["A", "10", "001"],
                                           ["B", None, "002"]]))
    write(tmp_path / "2.json", json.dumps([["tract", "NAME"], ["003", "C"]]))
    write(tmp_path / "3.json", "not json")
    write(tmp_path / "4.json", json.dumps([["NAME"]]))
    write(tmp_path / "5.json", "[]")
    rows = decode_json_table(read_json_tables(spark, str(tmp_path)),
                             {"NAME": "name", "RENT": "rent", "tract": "tract"})
    assert sorted(rows.collect()) == [("A", "10", "001"), ("B", None, "002"), ("C", None, "003")]


def test_listing_reads_no_contents(spark, tmp_path):
    write(tmp_path / "a.csv", "12345")
    write(tmp_path / "b.txt", "1")
    assert [r.length for r in list_landed(spark, str(tmp_path), "*.csv").collect()] == [5]


def test_tables_replace_or_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    write_table(spark.range(5), path, mode="ignore")
    assert spark.read.parquet(path).count() == 3
    write_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError):
        write_table(spark.range(1))


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, 2001).otherwise(2002).alias("year"))
    write_table(df, path, partition_by=["year"])
    back = spark.read.parquet(path)
    assert back.filter("year = 2002").count() == 100 and back.count() == 1000
    plan = back.filter("year = 2002")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_exports_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, ' "a", b ', "x\ny"), (2, None, "")], "id long, s string, t string")
    paths = export_all({"one": df}, str(tmp_path), single_file=True)
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    back = read_csv(spark, paths["one"], layout("id s t"), multiline=True)
    assert sorted(back.collect()) == [("1", ' "a", b ', "x\ny"), ("2", None, None)]


def test_single_file_has_every_row(spark, tmp_path):
    export_csv(spark.range(1_200_000), str(tmp_path / "big"), single_file=True)
    (file,) = (tmp_path / "big").glob("*.csv")
    with open(file) as f:
        assert sum(1 for _ in f) == 1_200_001


def test_single_file_in_order(spark, tmp_path):
    df = spark.range(0, 5000, numPartitions=7).select("id", F.lit("x").alias("x"))
    export_csv(df, str(tmp_path / "o"), single_file=True, order_by=[F.desc("id")])
    (file,) = (tmp_path / "o").glob("*.csv")
    lines = file.read_text().splitlines()
    assert lines[0] == "id,x" and lines[1:] == [f"{i},x" for i in range(4999, -1, -1)]
    export_csv(df.filter("id < 0"), str(tmp_path / "none"), single_file=True)


def test_one_file_is_filled_by_many_tasks(spark, tmp_path, monkeypatch):
    """The file is as one task writes it, and no task has more of it than a block."""
    monkeypatch.setattr(sinks, "BLOCK_BYTES", 1000)
    df = spark.range(3000, numPartitions=5).selectExpr(
        "id", "if(id % 3 = 0, null, concat('a, \"b\"\\n', id)) AS `the \"text\"`", "if(id % 2 = 0, '', ' c ') AS c")
    export_csv(df, str(tmp_path / "one task"), single_file=True, order_by=["id"])
    alone, = (tmp_path / "one task").glob("part-*.csv")
    monkeypatch.setattr(type(df), "repartition", lambda self, n, *c, f=type(df).repartition: f(
        self, n, *c) if n > 1 else pytest.fail("all rows in one task"))
    export_one_csv(df, str(tmp_path / "many"), order_by=["id"])
    many, = (tmp_path / "many").iterdir()
    assert many.name.startswith("part-") and many.read_bytes() == alone.read_bytes()
    export_one_csv(df, str(tmp_path / "any % order"))
    any_order, = (tmp_path / "any % order").iterdir()
    assert sorted(any_order.read_bytes()) == sorted(alone.read_bytes())
    with pytest.raises(FileExistsError):
        export_one_csv(df, str(tmp_path / "many"))


def test_one_file_of_no_rows_has_the_header(spark, tmp_path):
    export_one_csv(spark.range(0).selectExpr("id", "id AS b"), str(tmp_path / "none"))
    one, = (tmp_path / "none").iterdir()
    assert one.read_text() == "id,b\n"


def test_blocks_cover_the_files():
    files = [("a", 5), ("b", 0), ("c", 27), ("d", 1)]
    assert sinks._blocks(files, 10) == [
        (0, [("a", 0, 5), ("c", 0, 5)]), (10, [("c", 5, 10)]), (20, [("c", 15, 10)]), (30, [("c", 25, 2), ("d", 0, 1)])]


def test_responses_that_are_no_table(spark, tmp_path):
    for name, text in {"a": '[["x"],["1"]]', "b": "not json", "d": "[]", "e": '[["x"]]'}.items():
        write(tmp_path / f"{name}.json", text)
    landed = read_json_tables(spark, str(tmp_path))
    assert [r.x for r in decode_json_table(landed, ["x"]).collect()] == ["1"]
    assert sorted(r.path[-6] for r in rejected_responses(landed).collect()) == ["b", "d"]


def test_view(spark):
    register_view(spark.range(4), "four")
    assert spark.sql("SELECT count(*) AS n FROM four").collect()[0].n == 4
