"""An overwrite never erases a table, and an append after it lands again what it removed."""

from pyspark.sql import types as T

from bronzegate.operators.quality import value_diff, value_set_summary
from bronzegate.plans.landing import land
from bronzegate.session import shared_dir
from bronzegate.sources import bronze as B
from bronzegate import schemas as S


def test_exact_types(spark):
    big = spark.createDataFrame([("9007199254740992",)], "s string").selectExpr("cast(s as decimal(20,0)) v")
    next_one = spark.createDataFrame([("9007199254740993",)], "s string").selectExpr("cast(s as decimal(20,0)) v")
    for right in (next_one, next_one.selectExpr("cast(v as bigint) v")):
        row = value_set_summary(big, right, ["v"]).collect()[0]
        assert (row["n_left_only"], row["n_right_only"]) == (1, 1)
    assert value_diff(big, next_one, "v").count() == 1
    zero = spark.createDataFrame([(0.0, "a")], "v double, w string")
    minus = spark.createDataFrame([(-0.0, "a")], "v double, w string")
    rows = value_set_summary(zero, minus, ["v", "w"]).collect()
    assert all(r["n_left_only"] == r["n_right_only"] == 0 for r in rows)
    assert isinstance(big.schema["v"].dataType, T.DecimalType)


def test_empty_overwrite_keeps_tables_and_append_lands_again(spark, tmp_path):
    day = "EXT_MDSAssessmentExtract{}_Ontario_2024-01-0{}.csv"
    heads = {
        S.QUESTIONS: S.QUESTIONS_STRING_COLUMNS + S.QUESTIONS_DATE_COLUMNS,
        S.SCORING: S.SCORING_STRING_COLUMNS + S.SCORING_FLOAT_COLUMNS + S.SCORING_DATE_COLUMNS,
    }
    dates = set(S.QUESTIONS_DATE_COLUMNS + S.SCORING_DATE_COLUMNS)
    folders = []
    for n in (1, 2):
        folder = tmp_path / f"raw{n}"
        folder.mkdir()
        for kind, columns in heads.items():
            row = ["2024-01-02 00:00:00" if c in dates else "1" for c in columns]
            (folder / day.format("Scoring" if kind == S.SCORING else "", n)).write_text("|".join(columns) + "\n" + "|".join(row) + "\n")
        folders.append(str(folder))
    none = tmp_path / "none"
    none.mkdir()
    bronze = shared_dir(spark, "overwrite-test")
    count = lambda: B.read_table(spark, B.table_path(bronze, S.QUESTIONS)).count()
    land(spark, folders[0], bronze)
    land(spark, str(none), bronze, mode="overwrite")
    assert count() == 1
    land(spark, folders[1], bronze, mode="overwrite")
    assert count() == 1
    land(spark, folders[0], bronze)
    assert count() == 2
