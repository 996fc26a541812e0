"""Landing job on hand-written edge files (FIXTURES.md section 3)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from bronzegate import schemas as S
from bronzegate.plans.landing import land
from bronzegate.sources import bronze as B

Q_HEADER = "|".join(S.QUESTIONS_STRING_COLUMNS + S.QUESTIONS_DATE_COLUMNS)
S_HEADER = "|".join(S.SCORING_STRING_COLUMNS + S.SCORING_FLOAT_COLUMNS + S.SCORING_DATE_COLUMNS)
TS = "2024-01-05 10:00:00"
RUN_TS = dt.datetime(2024, 2, 1, 12, 0, 0)


def q_row(fac="F1", res="R1", aid="A1", unit="U1", answer="yes", ard=TS, ans_date=TS):
    return "|".join([fac, res, unit, aid, "T", "k1", "v1", answer, ard, ans_date])


def s_row(fac="F1", res="R1", aid="A1", cmi="1.5", ard=TS):
    scores = [cmi] + ["2"] * (len(S.SCORING_FLOAT_COLUMNS) - 1)
    return "|".join([fac, res, "U1", aid, "Done", "RG"] + scores + [ard, TS, TS, ""])


def qname(tag, date="2024-01-05", inst="EXT", prov="Ontario"):
    return f"{inst}_MDSAssessmentExtract{tag}_{prov}_{date}.csv"


def sname(tag, date="2024-01-05", inst="EXT", prov="Ontario"):
    return f"{inst}_MDSAssessmentExtract{tag}Scoring_{prov}_{date}.csv"


def write(d, name, text):
    with open(os.path.join(d, name), "w", newline="") as f:
        f.write(text)


def pair(d, tag, q_lines, s_lines, q_header=Q_HEADER, s_header=S_HEADER):
    write(d, qname(tag), "\n".join([q_header] + q_lines) + "\n")
    write(d, sname(tag), "\n".join([s_header] + s_lines) + "\n")


@pytest.fixture
def dirs(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    return str(raw), str(tmp_path / "bronze")


def run(spark, raw, bronze, **kw):
    res = land(spark, raw, bronze, run_ts=RUN_TS, **kw)
    log = {r["FILE_NAME"]: r.asDict() for r in B.read_log(spark, bronze).collect()}
    return res, log


def questions(spark, bronze):
    return B.read_table(spark, B.table_path(bronze, S.QUESTIONS))


def test_clean_and_unequal_pairs(spark, dirs):
    raw, bronze = dirs
    pair(raw, "A", [q_row(aid="1"), q_row(aid="2"), q_row(aid="2")], [s_row(aid="1"), s_row(aid="2")])
    pair(raw, "B", [q_row(aid="1")], [s_row(aid="1"), s_row(aid="9")])
    _, log = run(spark, raw, bronze)
    a = log[qname("A")]
    assert (a["N_ROWS"], a["N_UNIQUE_ASSESSMENTS"], a["READ_SUCCESS"], a["INGEST_SUCCESS"]) == (3, 2, True, True)
    assert a["INGEST_ERRORS"] == [] and a["READ_ERRORS"] == []
    b = log[sname("B")]
    assert b["INGEST_SUCCESS"] and len(b["INGEST_ERRORS"]) == 1
    assert "Relationship: ColumnDomainRelationship.RIGHT_NOT_LEFT." in b["INGEST_ERRORS"][0]
    assert log[qname("B")]["INGEST_ERRORS"] == b["INGEST_ERRORS"]
    q = questions(spark, bronze)
    assert q.count() == 4
    ids = {r[0] for r in q.select(S.ID_COLUMN).collect()}
    assert "EXT|Ontario|F1|R1|1|2024-01-05" in ids
    assert q.schema["FILE_DATE"].dataType.simpleString() == "date"
    assert q.schema["ARD"].dataType.simpleString() == "timestamp_ntz"


def test_parse_rules_strict(spark, dirs):
    raw, bronze = dirs
    lines = [
        q_row(aid="1", unit='"a|b"'),                 # quoted separator
        q_row(aid="2", unit='"q""q"'),                # doubled quote
        q_row(aid="3", unit='"l1\nl2"'),              # quoted newline
        "",                                           # blank line: skipped
        q_row(aid="4", unit="NA"),                    # NA token -> null -> ''
        q_row(aid="5", res=""),                       # missing key part -> 'nan' in ID
        "F1|R1|U1|6",                                 # short row: null padded
        q_row(aid="7", ard="2024-1-5 3:4:5"),         # unpadded date parts
    ]
    pair(raw, "P", lines, [s_row(aid=str(i)) for i in range(1, 8)])
    _, log = run(spark, raw, bronze)
    rec = log[qname("P")]
    assert rec["READ_SUCCESS"] and rec["READ_ERRORS"] == [] and rec["N_ROWS"] == 7
    rows = {r["Assessment ID"]: r for r in questions(spark, bronze).collect()}
    assert rows["1"]["Unit"] == "a|b"
    assert rows["2"]["Unit"] == 'q"q'
    assert rows["3"]["Unit"] == "l1\nl2"
    assert rows["4"]["Unit"] == ""
    assert rows["5"][S.ID_COLUMN] == "EXT|Ontario|F1|nan|5|2024-01-05"
    assert rows["5"]["Resident ID"] == ""
    assert rows["6"]["Answer"] == "" and rows["6"]["ARD"] is None
    assert rows["7"]["ARD"] == dt.datetime(2024, 1, 5, 3, 4, 5)


def test_long_row_goes_tolerant(spark, dirs):
    raw, bronze = dirs
    lines = [q_row(aid="1"), q_row(aid="2") + "|extra", ' ' + q_row(aid="3", unit='"NA"') + ' ', ""]
    pair(raw, "L", lines, [s_row(aid="1"), s_row(aid="2"), s_row(aid="3")])
    _, log = run(spark, raw, bronze)
    rec = log[qname("L")]
    assert rec["READ_SUCCESS"]
    assert len(rec["READ_ERRORS"]) == 1 and "Expected 10 fields, saw 11" in rec["READ_ERRORS"][0]
    # the blank line becomes one row with an empty first field
    assert rec["N_ROWS"] == 4
    rows = {r["Assessment ID"]: r for r in questions(spark, bronze).collect()}
    assert rows["2"]["Answer"] == "yes"     # extra field dropped
    assert rows["3"]["Unit"] == "NA"        # tolerant parse keeps NA text, strips quotes
    assert rows["3"]["Facility ID"] == "F1"  # surrounding whitespace trimmed


def test_trailing_empty_field_and_unclosed_quote(spark, dirs):
    raw, bronze = dirs
    pair(raw, "T", [q_row(aid="1") + "|"], [s_row(aid="1")])
    pair(raw, "U", [q_row(aid="1", unit='"open')], [s_row(aid="1")])
    _, log = run(spark, raw, bronze)
    assert log[qname("T")]["READ_ERRORS"] and log[qname("T")]["READ_SUCCESS"]
    assert "EOF inside string" in log[qname("U")]["READ_ERRORS"][0]
    assert log[qname("U")]["INGEST_SUCCESS"]


def test_reordered_header_and_undeclared_column(spark, dirs):
    raw, bronze = dirs
    cols = S.QUESTIONS_STRING_COLUMNS + S.QUESTIONS_DATE_COLUMNS
    perm = list(reversed(cols)) + ["Extra"]
    vals = dict(zip(cols, q_row(aid="1").split("|")))
    vals["Extra"] = "x"
    pair(raw, "R", ["|".join(vals[c] for c in perm)], [s_row(aid="1")], q_header="|".join(perm))
    pair(raw, "N", [q_row(aid="1")], [s_row(aid="1")])
    _, log = run(spark, raw, bronze)
    assert log[qname("R")]["INGEST_SUCCESS"] and log[qname("R")]["N_UNIQUE_ASSESSMENTS"] == 1
    q = questions(spark, bronze)
    r = q.where(F.col("FILE_NAME") == qname("R")).collect()[0]
    n = q.where(F.col("FILE_NAME") == qname("N")).collect()[0]
    assert [r[c] for c in cols] == [n[c] for c in cols]
    assert r["Extra"] == "x" and n["Extra"] is None


def test_unreadable_files(spark, dirs):
    raw, bronze = dirs
    missing_col = "|".join(S.QUESTIONS_STRING_COLUMNS[:-1] + S.QUESTIONS_DATE_COLUMNS)
    pair(raw, "M", ["F1|R1|U1|1|T|k|v|" + TS + "|" + TS], [s_row(aid="1")], q_header=missing_col)
    pair(raw, "F", [q_row(aid="1")], [s_row(aid="1", cmi="1.2.3")])
    pair(raw, "D", [q_row(aid="1", ard="2024-13-05 00:00:00")], [s_row(aid="1")])
    pair(raw, "S", [q_row(aid="1", ard="2024-01-05 00:00:00.5")], [s_row(aid="1")])
    write(raw, qname("Z"), "")
    write(raw, sname("Z"), S_HEADER + "\n" + s_row(aid="1") + "\n")
    _, log = run(spark, raw, bronze)
    for bad in (qname("M"), sname("F"), qname("D"), qname("S"), qname("Z")):
        rec = log[bad]
        assert not rec["READ_SUCCESS"], bad
        assert rec["N_ROWS"] == rec["N_RESIDENTS"] == rec["N_UNIQUE_ASSESSMENTS"] == -1, bad
        assert rec["READ_ERRORS"], bad
        assert not rec["INGEST_SUCCESS"]
    assert not log[sname("M")]["INGEST_SUCCESS"]  # the partner fails too
    assert any("unreadable" in e for e in log[sname("M")]["INGEST_ERRORS"])
    q = questions(spark, bronze)
    assert q is None or q.count() == 0  # nothing written: no data files yet


def test_header_only_side_fails_pair(spark, dirs):
    raw, bronze = dirs
    pair(raw, "E", [], [s_row(aid="1")])
    _, log = run(spark, raw, bronze)
    q, s = log[qname("E")], log[sname("E")]
    assert q["READ_SUCCESS"] and q["N_ROWS"] == 0 and not q["INGEST_SUCCESS"] and not s["INGEST_SUCCESS"]
    assert "Left dataframe is empty" in s["INGEST_ERRORS"][0]


def test_unpaired_fail_and_quarantine(spark, dirs):
    raw, bronze = dirs
    pair(raw, "A", [q_row()], [s_row()])
    write(raw, sname("Lonely"), S_HEADER + "\n" + s_row() + "\n")
    with pytest.raises(ValueError, match="not paired"):
        land(spark, raw, bronze, run_ts=RUN_TS)
    _, log = run(spark, raw, bronze, on_unpaired="quarantine")
    assert not log[sname("Lonely")]["INGEST_SUCCESS"]
    assert log[qname("A")]["INGEST_SUCCESS"]


def test_no_files_and_idempotent_append(spark, dirs):
    raw, bronze = dirs
    res = land(spark, raw, bronze, run_ts=RUN_TS)
    assert res.log.count() == 0
    pair(raw, "A", [q_row(aid="1"), q_row(aid="2")], [s_row(aid="1"), s_row(aid="2")])
    run(spark, raw, bronze)
    res2 = land(spark, raw, bronze, run_ts=RUN_TS + dt.timedelta(hours=1))
    assert [r["INGEST_ERRORS"] for r in res2.log.collect()] == [["skipped: already ingested, content unchanged"]] * 2
    assert questions(spark, bronze).count() == 2
    # overwrite replaces the whole table with the batch
    land(spark, raw, bronze, mode="overwrite", run_ts=RUN_TS + dt.timedelta(hours=2))
    assert questions(spark, bronze).count() == 2


def test_filters_and_glob(spark, dirs):
    raw, bronze = dirs
    pair(raw, "A", [q_row()], [s_row()])
    write(raw, "REV_MDSAssessmentExtract_Alberta_2024-01-06.csv", Q_HEADER + "\n" + q_row() + "\n")
    write(raw, "REV_MDSAssessmentExtractScoring_Alberta_2024-01-06.csv", S_HEADER + "\n" + s_row() + "\n")
    write(raw, "unrelated.txt", "x")
    _, log = run(spark, raw, bronze, filters=[F.col("PROVINCE") == "Ontario", lambda m: m.INSTANCE == "EXT"])
    assert set(log) == {qname("A"), sname("A")}


def test_parameters_validated_first(spark, dirs):
    raw, bronze = dirs
    with pytest.raises(ValueError, match="archive_dir"):
        land(spark, raw, bronze, archive_behaviour=("tarball", "ingested"))
    with pytest.raises(ValueError, match="mode"):
        land(spark, raw, bronze, mode="merge")


def test_archive_after_landing(spark, dirs, tmp_path):
    raw, bronze = dirs
    pair(raw, "A", [q_row(aid="1")], [s_row(aid="1")])
    pair(raw, "B", [q_row(aid="1")], [s_row(aid="1"), s_row(aid="2")])
    pair(raw, "E", [], [s_row(aid="1")])
    arc = str(tmp_path / "archive")
    res = land(spark, raw, bronze, run_ts=RUN_TS, archive_dir=arc,
               archive_behaviour=("tarball", "ingested"), archive_err_behaviour=("move", "ingested-review"))
    plan = {r["FILE_NAME"]: (r["action"], r["destination"]) for r in res.disposition.collect()}
    assert plan[qname("A")] == ("archive", "ingested_2024-02-01_12-00")
    assert plan[qname("B")] == ("move", "ingested-review_2024-02-01_12-00")
    assert plan[qname("E")] == ("stay", None)
    left = sorted(os.listdir(raw))
    assert [f for f in left if f.endswith(".csv")] == sorted([qname("E"), sname("E")])
    moved = os.listdir(os.path.join(arc, "ingested-review_2024-02-01_12-00"))
    assert qname("B") in moved and sname("B") in moved
    bundle = spark.read.parquet(os.path.join(arc, "ingested_2024-02-01_12-00"))
    assert sorted(r[0] for r in bundle.select("name").collect()) == sorted([qname("A"), sname("A")])


def test_crash_between_writes_leaves_no_visible_rows(spark, dirs, monkeypatch):
    raw, bronze = dirs
    pair(raw, "A", [q_row(aid="1"), q_row(aid="2")], [s_row(aid="1"), s_row(aid="2")])
    import bronzegate.plans.landing as L

    real = L.B.write_bronze
    calls = {"n": 0}

    def failing(df, path, *a, **k):
        calls["n"] += 1
        if calls["n"] == 2:  # Questions written, Scoring write dies
            raise RuntimeError("executor lost")
        return real(df, path, *a, **k)

    monkeypatch.setattr(L.B, "write_bronze", failing)
    with pytest.raises(RuntimeError):
        land(spark, raw, bronze, run_ts=RUN_TS)
    monkeypatch.setattr(L.B, "write_bronze", real)
    assert questions(spark, bronze).count() == 2          # orphan rows physically there
    assert B.read_committed(spark, bronze, S.QUESTIONS) is None  # no log yet: nothing committed
    land(spark, raw, bronze, run_ts=RUN_TS + dt.timedelta(minutes=5))
    assert questions(spark, bronze).count() == 4          # rerun appended again
    assert B.read_committed(spark, bronze, S.QUESTIONS).count() == 2
    assert B.read_committed(spark, bronze, S.SCORING).count() == 2


def test_skip_blank_and_skip_unequal(spark, dirs):
    raw, bronze = dirs
    pair(raw, "L", [q_row(aid="1"), q_row(aid="2") + "|extra", ""], [s_row(aid="1"), s_row(aid="2")])
    pair(raw, "B", [q_row(aid="1")], [s_row(aid="1"), s_row(aid="9")])
    _, log = run(spark, raw, bronze, skip_blank=True, on_unequal="skip")
    assert log[qname("L")]["N_ROWS"] == 2 and log[qname("L")]["INGEST_SUCCESS"]
    assert not log[qname("B")]["INGEST_SUCCESS"] and not log[sname("B")]["INGEST_SUCCESS"]
    assert questions(spark, bronze).count() == 2


def test_byte_order_mark_and_leading_blank_lines(spark, dirs):
    raw, bronze = dirs
    write(raw, qname("M"), "﻿" + Q_HEADER + "\n" + q_row(aid="1") + "\n")
    write(raw, sname("M"), "\n\n" + S_HEADER + "\n" + s_row(aid="1") + "\n")
    _, log = run(spark, raw, bronze)
    for f in (qname("M"), sname("M")):
        assert log[f]["READ_SUCCESS"] and log[f]["INGEST_SUCCESS"] and log[f]["N_ROWS"] == 1, log[f]
    r = questions(spark, bronze).collect()[0]
    assert r["Facility ID"] == "F1" and r[S.ID_COLUMN] == "EXT|Ontario|F1|R1|1|2024-01-05"


def test_gated_writes_do_not_shuffle_rows(spark, dirs, monkeypatch):
    raw, bronze = dirs
    pair(raw, "A", [q_row(aid="1")], [s_row(aid="1")])
    import bronzegate.plans.landing as L

    plans = []  # no quoted line breaks here: rows go from the scan to the write without a shuffle
    real = L.B.write_bronze

    def spy(df, path, *a, **k):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, path, *a, **k)

    monkeypatch.setattr(L.B, "write_bronze", spy)
    land(spark, raw, bronze, run_ts=RUN_TS)
    assert len(plans) == 2
    for p in plans:
        assert "BroadcastHashJoin" in p and "LeftSemi" in p
        assert "Exchange hashpartitioning" not in p
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct"):
            assert bad not in p


def test_tiny_splits_give_the_same_rows(spark, dirs, tmp_path):
    raw, bronze = dirs
    lines = [q_row(aid=str(i), unit=f'"u{i}\nsecond|line"' if i % 3 == 0 else f"u{i}") for i in range(30)]
    pair(raw, "ML", lines, [s_row(aid=str(i)) for i in range(30)])
    _, log = run(spark, raw, bronze)
    whole = sorted(tuple(r) for r in questions(spark, bronze).select("Assessment ID", "Unit", S.ID_COLUMN).collect())
    bronze2 = str(tmp_path / "bronze2")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")  # many splits per file
    try:
        land(spark, raw, bronze2, run_ts=RUN_TS)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    split = sorted(tuple(r) for r in B.read_table(spark, B.table_path(bronze2, S.QUESTIONS))
                   .select("Assessment ID", "Unit", S.ID_COLUMN).collect())
    assert whole == split and len(whole) == 30
    assert dict(whole_row[:2] for whole_row in whole)["3"] == "u3\nsecond|line"


def test_null_report_is_persisted(spark, dirs):
    raw, bronze = dirs
    pair(raw, "N", [q_row(aid="1", unit="NA"), q_row(aid="2", unit="")], [s_row(aid="1"), s_row(aid="2")])
    res, _ = run(spark, raw, bronze)
    rep = {(r.FILE_NAME, r.column_name): (r.nulls, r.n, r.severity)
           for r in spark.read.parquet(B.null_report_path(bronze)).collect()}
    assert rep[(qname("N"), "Unit")] == (2, 2, "WARNING")
    assert all(v[0] > 0 for v in rep.values())


def test_uncovered_ids_report(spark, dirs):
    raw, bronze = dirs
    pair(raw, "B", [q_row(aid="1"), q_row(aid="3")], [s_row(aid="1"), s_row(aid="9")])
    res, _ = run(spark, raw, bronze)
    got = sorted((r.FILE_WITH, r.FILE_WITHOUT, r.MISSING_ID) for r in res.uncovered.collect())
    assert got == sorted([(qname("B"), sname("B"), "EXT|Ontario|F1|R1|3|2024-01-05"),
                          (sname("B"), qname("B"), "EXT|Ontario|F1|R1|9|2024-01-05")])
