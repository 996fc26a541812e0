"""Bad names, clashing columns and deliveries of corrected files."""

import datetime as dt
import os

from pyspark.sql import functions as F

from bronzegate import schemas as S
from bronzegate.operators.conform import conform
from bronzegate.plans.landing import land
from bronzegate.sources import bronze as B

from test_landing import Q_HEADER, RUN_TS, S_HEADER, dirs, pair, q_row, qname, run, s_row, sname, write  # noqa: F401


def test_a_bad_name_fails_its_pair_unread(spark, dirs):
    raw, bronze = dirs
    pair(raw, "A", [q_row(aid="1")], [s_row(aid="1")])
    names = "EXT_MDSAssessmentExtract_Ontario_notadate.csv", "EXT_MDSAssessmentExtractScoring_Ontario_notadate.csv"
    write(raw, names[0], Q_HEADER + "\n" + q_row(aid="1") + "\n")
    write(raw, names[1], S_HEADER + "\n" + s_row(aid="999") + "\n")
    _, log = run(spark, raw, bronze)
    for n in names:
        assert not log[n]["READ_SUCCESS"] and not log[n]["INGEST_SUCCESS"] and log[n]["N_ROWS"] == -1
        assert log[n]["READ_ERRORS"] == ["file name does not give FILE_DATE"]
        assert log[n]["INGEST_ERRORS"] == [f"unreadable: {x}" for x in names]
    assert log[qname("A")]["INGEST_SUCCESS"]
    assert B.read_committed(spark, bronze, S.QUESTIONS).count() == 1


def test_lineage_wins_over_a_raw_column(spark, dirs):
    raw, bronze = dirs
    pair(raw, "A", [q_row(aid="1") + "|mine|theirs|low"], [s_row(aid="1")], q_header=Q_HEADER + "|INSTANCE|file_name|unit")
    _, log = run(spark, raw, bronze)
    assert log[qname("A")]["INGEST_SUCCESS"]
    row = B.read_committed(spark, bronze, S.QUESTIONS).collect()[0]
    assert row["INSTANCE"] == "EXT" and row["FILE_NAME"] == qname("A") and row["Unit"] == "U1"
    frame = spark.createDataFrame([tuple("x" * 10) + (qname("A"), "raw")], [*S.declared_columns(S.QUESTIONS), "FILE_NAME", "Province"])
    assert conform(frame, S.QUESTIONS, dt.datetime(2024, 1, 1)).select("PROVINCE").first()[0] == "Ontario"


def test_corrected_and_unchanged_deliveries(spark, dirs):
    raw, bronze = dirs
    pair(raw, "A", [q_row(aid="1")], [s_row(aid="1")])
    pair(raw, "B", [q_row(aid="7")], [s_row(aid="7")])
    first, _ = run(spark, raw, bronze)
    pair(raw, "A", [q_row(aid="1"), q_row(aid="2")], [s_row(aid="1"), s_row(aid="2")])  # corrected
    for n in (qname("B"), sname("B")):  # touched, same content
        os.utime(os.path.join(raw, n), (1, 1))
    second = land(spark, raw, bronze, run_ts=RUN_TS + dt.timedelta(hours=1))
    log = {r["FILE_NAME"]: r for r in second.log.collect()}
    assert log[qname("A")]["INGEST_SUCCESS"] and log[qname("A")]["N_ROWS"] == 2
    assert log[qname("B")]["INGEST_ERRORS"] == ["skipped: already ingested, content unchanged"]
    rows = B.read_committed(spark, bronze, S.QUESTIONS)
    assert sorted(r[0] for r in rows.select("Assessment ID").collect()) == ["1", "2", "7"]
    assert rows.where(F.col(B.BATCH_COLUMN) == first.batch_id).count() == 1
    third = land(spark, raw, bronze, run_ts=RUN_TS + dt.timedelta(hours=2))  # nothing new: nothing read
    assert {tuple(r["INGEST_ERRORS"]) for r in third.log.collect()} == {("skipped: already ingested, content unchanged",)}
    assert {r["CONTENT_HASH"] for r in third.log.where("FILE_LENGTH IS NOT NULL").collect()} >= {None}


def test_unpaired_files_are_all_listed(spark, dirs):
    import pytest

    raw, bronze = dirs
    for i in range(60):
        write(raw, qname(f"L{i}"), Q_HEADER + "\n")
    with pytest.raises(ValueError, match="60 file"):
        land(spark, raw, bronze, run_ts=RUN_TS)
    assert spark.read.parquet(B.unpaired_path(bronze)).count() == 60
