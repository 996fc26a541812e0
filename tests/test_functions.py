"""Scalar expressions (P1, P3-P5, P7, P11, P12) and plan guard rails."""

import datetime as dt

from pyspark.sql import functions as F

from bronzegate.functions import columns as C
from bronzegate.operators.quality import value_diff, value_set_summary


def test_parse_file_name(spark):
    df = spark.createDataFrame([
        ("EXT_MDSAssessmentExtract_Ontario_2024-01-05.csv",),
        ("REV_MDSAssessmentExtractScoring_Alberta_20240105.csv",),
        ("odd.csv",),
    ], "FILE_NAME string")
    rows = [r.asDict() for r in df.select(*C.file_metadata_columns(F.col("FILE_NAME"))).collect()]
    assert rows[0] == {"FILE_NAME": "EXT_MDSAssessmentExtract_Ontario_2024-01-05.csv",
                       "FILE_DATE": dt.date(2024, 1, 5), "INSTANCE": "EXT", "PROVINCE": "Ontario",
                       "EXTRACT_TYPE": "Questions"}
    assert rows[1]["FILE_DATE"] == dt.date(2024, 1, 5) and rows[1]["EXTRACT_TYPE"] == "Scoring"
    assert rows[2]["PROVINCE"] is None and rows[2]["FILE_DATE"] is None
    pk = df.select(C.pair_key(F.col("FILE_NAME"))).collect()[1][0]
    assert pk == "REV_MDSAssessmentExtract_Alberta_20240105.csv"


def test_composite_id_missing_parts(spark):
    df = spark.createDataFrame([("EXT", "Ontario", None, "R", "A", dt.date(2024, 1, 5))],
                               "INSTANCE string, PROVINCE string, `Facility ID` string, `Resident ID` string, "
                               "`Assessment ID` string, FILE_DATE date")
    assert df.select(C.unique_assessment_id()).first()[0] == "EXT|Ontario|nan|R|A|2024-01-05"


def test_float_and_date_rules(spark):
    df = spark.createDataFrame([(" 1.5 ",), ("1d",), ("1e3",), ("nan",), ("abc",), (None,), (".5",)], "v string")
    got = [(r[0], r[1]) for r in df.select(C.to_float(F.col("v")), C.float_failed(F.col("v"))).collect()]
    assert got[0] == (1.5, False) and got[1] == (None, True) and got[2] == (1000.0, False)
    assert got[4] == (None, True) and got[5] == (None, False) and got[6] == (0.5, False)
    d = spark.createDataFrame([("2024-1-5 3:4:5",), ("2024-01-05 03:04:05.5",), ("2024-13-01 00:00:00",), ("",)],
                              "v string")
    got = [(r[0], r[1]) for r in d.select(C.to_timestamp_ntz(F.col("v")), C.timestamp_failed(F.col("v"))).collect()]
    assert got[0] == (dt.datetime(2024, 1, 5, 3, 4, 5), False)
    assert got[1] == (None, True) and got[2] == (None, True) and got[3] == (None, False)


def test_na_tokens_and_nonempty(spark):
    df = spark.createDataFrame([("NA",), ("n/a",), ("",), ("x",), ("na",)], "v string")
    assert [r[0] for r in df.select(C.na_to_null(F.col("v"))).collect()] == [None, None, None, "x", "na"]
    a = spark.createDataFrame([([],), (None,), (["e"],)], "a array<string>")
    assert [r[0] for r in a.select(C.nonempty(F.col("a"))).collect()] == [False, False, True]


def test_clean_split(spark):
    df = spark.createDataFrame([('  "a"|b|""c"" \t',), ("",)], "v string")
    assert [r[0] for r in df.select(C.clean_split(F.col("v"))).collect()] == [["a", "b", "c"], [""]]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_python_or_cartesian(spark):
    left = spark.range(1000).select((F.col("id") % 97).alias("k"), F.col("id").alias("v"))
    right = spark.range(500).select((F.col("id") % 89).alias("k"))
    for df in (value_set_summary(left, right, "k"), value_diff(left, right, "k")):
        p = _plan(df)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in p, (bad, p)
    # partial aggregation before the shuffle
    assert "partial_max" in _plan(value_set_summary(left, right, "k"))


def test_dates_ignore_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        d = spark.createDataFrame([("2024-3-10 2:30:00",)], "v string")  # inside the DST gap there
        assert d.select(C.to_timestamp_ntz(F.col("v"))).first()[0] == dt.datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_timestamps_to_micros(spark):
    df = spark.sql("SELECT timestamp'2024-01-05 01:02:03.123456' AS t, 1 AS x")
    out = C.timestamps_to_micros(df)
    assert out.schema["t"].dataType.simpleString() == "timestamp_ntz"
    assert out.first()["t"].microsecond == 123456
