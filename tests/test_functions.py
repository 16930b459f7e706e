import datetime

import pytest
from pyspark.sql import functions as F

from burgage import functions as fn


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_initcap_after_punctuation(spark):
    got = column(spark, ["FOOD/BEVERAGE hndlng", "WAREHOUSE,NO FRNITUR", "sign - ERECT",
                         "o'neil (old)a", "tourist hotel/MOTEL", "", None, "tab\tbed", "a\\b^c[d]"],
                 fn.initcap_words)
    assert got == ["Food/Beverage Hndlng", "Warehouse,No Frnitur", "Sign - Erect",
                   "O'neil (Old)A", "Tourist Hotel/Motel", "", None, "Tab\tBed", "A\\B^C[D]"]


def test_initcap_keeps_the_marker_character(spark):
    for text in ["a\x01 b", "a\x01b", "-\x01 \x01\x01  b", "\x01", "x-\x01"]:
        assert column(spark, [text], fn.initcap_words)[0].lower() == text.lower()


def test_initcap_by_blanks_only(spark):
    assert column(spark, ["FOOD/BEVERAGE hndlng"], lambda c: fn.initcap_words(c, "space")) == \
        ["Food/beverage Hndlng"]
    with pytest.raises(ValueError):
        fn.initcap_words("v", "other")


def test_parse_timestamp(spark):
    values = {
        "1/5/2018": datetime.datetime(2018, 1, 5), "01/05/2018": datetime.datetime(2018, 1, 5),
        "2018-01-05": datetime.datetime(2018, 1, 5), "2018-1-5": datetime.datetime(2018, 1, 5),
        " 1/5/2018": datetime.datetime(2018, 1, 5),
        "01/05/2018 10:30:00": datetime.datetime(2018, 1, 5, 10, 30),
        "2018-01-05T10:30:00.5": datetime.datetime(2018, 1, 5, 10, 30, 0, 500000),
        "13/45/2018": None, "2018-13-01": None, "20180105": None, "2018": None, "12:30": None,
        "": None, "-": None, "a/b/2018": None, "1/5/3/2018": None, "1/5/20181": None, None: None,
    }
    assert column(spark, list(values), fn.parse_timestamp) == list(values.values())
    assert column(spark, ["05.01.2018", "1/5/2018", "x"],
                  lambda c: fn.parse_timestamp(c, ["dd.MM.yyyy", "M/d/yyyy"])) == \
        [datetime.datetime(2018, 1, 5)] * 2 + [None]
    assert column(spark, ["1/5/2018", "x"], fn.parse_date) == [datetime.date(2018, 1, 5), None]


def test_days_between_counts_midnights(spark):
    df = spark.sql("""SELECT timestamp_ntz'2020-01-01 23:59:00' a, timestamp_ntz'2020-01-02 00:01:00' b
                      UNION ALL SELECT timestamp_ntz'2020-01-05 00:00:00', timestamp_ntz'2020-01-01 00:00:00'
                      UNION ALL SELECT NULL, timestamp_ntz'2020-01-01 00:00:00'""")
    assert [r[0] for r in df.select(fn.days_between("a", "b")).collect()] == [1, -4, None]


def test_numbers(spark):
    assert column(spark, ["12.0", "12.5", "-12.5", "x", " 7 ", "1e3", None, "NaN"],
                  fn.whole_number) == [12, 13, -13, None, 7, 1000, None, None]
    assert column(spark, ["1.5", "NaN", "x", None, "-2"], fn.number_or_null) == \
        [1.5, None, None, None, -2.0]
    assert column(spark, [-666666666, 0, 5, None], lambda c: fn.null_if(c, -666666666), "long") == \
        [None, 0, 5, None]
    assert column(spark, [1234567.5, 0.4, None], lambda c: fn.thousands(c, prefix="$"), "double") \
        == ["$1,234,568", "$0", None]


def test_percent_needs_a_positive_whole(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (1, -1), (1, None), (None, 3)], "p long, w long")
    assert [r[0] for r in df.select(fn.percent_of("p", "w")).collect()] == \
        [33.3, None, None, None, None]


def test_zero_fill_and_labels(spark):
    assert column(spark, ["1", "001", "1234", None], fn.zero_fill) == ["001", "001", "1234", None]
    assert column(spark, ["a", "b", None], lambda c: fn.label_for(c, {"a": "Alpha"})) == \
        ["Alpha", "b", None]


def test_headers_and_quarters(spark):
    assert fn.clean_header(" Neighborhoods - Analysis Boundaries ") == \
        "neighborhoods_analysis_boundaries"
    assert column(spark, [datetime.date(2018, 9, 30), datetime.date(2018, 10, 1), None],
                  fn.quarter_label, "date") == ["2018 Q3", "2018 Q4", None]
