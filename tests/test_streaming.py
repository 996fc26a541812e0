"""The incremental job lands the same rows as the batch job, also when a
pair straddles two micro-batches, and lands nothing twice on a rerun."""

import datetime as dt

from bronzegate import schemas as S
from bronzegate.plans.landing import land
from bronzegate.sources import bronze as B
from bronzegate.streaming.incremental import start_incremental_landing

import pytest

from test_landing import pair, q_row, qname, s_row, sname


def _rows(spark, bronze, et):
    t = B.read_table(spark, B.table_path(bronze, et))
    return sorted(tuple(r) for r in t.select("FILE_NAME", "Assessment ID", S.ID_COLUMN).collect())


def test_stream_equals_batch(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for tag, n in (("A", 2), ("B", 3), ("C", 1)):
        pair(str(raw), tag, [q_row(aid=str(i)) for i in range(n)], [s_row(aid=str(i)) for i in range(n)])
    batch_bronze = str(tmp_path / "bronze_batch")
    land(spark, str(raw), batch_bronze, run_ts=dt.datetime(2024, 1, 1))

    stream_bronze = str(tmp_path / "bronze_stream")
    ckpt = str(tmp_path / "ckpt")
    q = start_incremental_landing(spark, str(raw), stream_bronze, checkpoint_dir=ckpt, max_files_per_trigger=1)
    q.awaitTermination(300)
    for et in S.EXTRACT_TYPES:
        assert _rows(spark, stream_bronze, et) == _rows(spark, batch_bronze, et)

    # New pair arrives: only it is landed on the next run.
    pair(str(raw), "D", [q_row(aid="1")], [s_row(aid="1")])
    q = start_incremental_landing(spark, str(raw), stream_bronze, checkpoint_dir=ckpt)
    q.awaitTermination(300)
    assert len(_rows(spark, stream_bronze, S.QUESTIONS)) == 7
    log = B.read_log(spark, stream_bronze)
    assert log.count() == 8 and log.select("FILE_NAME").distinct().count() == 8


def _paths(spark, raw, names):
    rows = [(f"file:{raw}/{n}", (raw / n).stat().st_size, dt.datetime.fromtimestamp(int((raw / n).stat().st_mtime))) for n in names]
    return spark.createDataFrame(rows, "path string, length long, modificationTime timestamp")


def test_late_missing_and_replayed(spark, tmp_path, monkeypatch):
    """A partner two batches late lands; one that never comes is given up; a replay leaves rows once."""
    import bronzegate.plans.landing as L
    from bronzegate.streaming.incremental import batch_identity, land_batch

    raw = tmp_path / "raw"
    raw.mkdir()
    for tag in "ABC":
        pair(str(raw), tag, [q_row(aid="1"), q_row(aid="2")], [s_row(aid="1"), s_row(aid="2")])
    bronze, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    step = lambda n, names, **k: land_batch(spark, _paths(spark, raw, names), n, bronze, ckpt, **k)
    step(0, [qname("A"), qname("C")])
    real = L.B.append_log

    def dies(*_):
        raise RuntimeError("lost between table and log")

    monkeypatch.setattr(L.B, "append_log", dies)
    with pytest.raises(RuntimeError):
        step(1, [qname("B"), sname("B")])
    monkeypatch.setattr(L.B, "append_log", real)
    identity = batch_identity(spark, ckpt, 1)
    step(1, [qname("B"), sname("B")])
    assert batch_identity(spark, ckpt, 1) == identity > batch_identity(spark, ckpt, 0)
    assert [r[0] for r in _rows(spark, bronze, S.QUESTIONS)] == [qname("B")] * 2  # the raw table, not the committed view
    step(2, [sname("A")], unpaired_after=0)
    log = {r["FILE_NAME"]: r for r in B.read_log(spark, bronze).collect()}
    assert log[qname("A")]["INGEST_SUCCESS"] and log[sname("A")]["INGEST_SUCCESS"]
    assert not log[qname("C")]["INGEST_SUCCESS"] and log[qname("C")]["INGEST_ERRORS"] == ["unpaired: no matching file"]
    assert len(log) == B.read_log(spark, bronze).count() == 5
