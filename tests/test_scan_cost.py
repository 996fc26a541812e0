"""What a landing run reads and how often: each asked-for file once parsed, no other file opened, small splits together."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bronzegate import schemas as S
from bronzegate.plans import landing
from bronzegate.sources import bronze as B
from bronzegate.sources import quotes as Q
from bronzegate.sources.discover import detect_incoming
from bronzegate.sources.scan import scan_all

Q_NAME, S_NAME = "EXT_MDSAssessmentExtract_Ontario_2024-01-05.csv", "EXT_MDSAssessmentExtractScoring_Ontario_2024-01-05.csv"


def _file(path, et, rows):
    names = S.declared_columns(et)
    lines = ["|".join(names)]
    for i in range(rows):
        value = {c: "2024-1-5 1:2:3" for c in S.date_columns(et)} | {c: "1.5" for c in S.float_columns(et)}
        lines.append("|".join(value.get(c, '"a|""b""\nc"' if c == "Unit" and i % 3 == 0 else str(i)) for c in names))
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture()
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    _file(folder / Q_NAME, S.QUESTIONS, 9)
    _file(folder / S_NAME, S.SCORING, 9)
    return folder


def test_write_does_not_parse_the_raw_files_again(spark, raw, tmp_path, monkeypatch):
    write = B.write_bronze

    def emptied(rows, *args, **kwargs):
        for f in raw.iterdir():
            f.write_text("")
        write(rows, *args, **kwargs)

    monkeypatch.setattr(landing.B, "write_bronze", emptied)
    landing.land(spark, str(raw), str(tmp_path / "bronze"), run_ts=dt.datetime(2024, 1, 1))
    for et in S.EXTRACT_TYPES:
        rows = B.read_committed(spark, str(tmp_path / "bronze"), et)
        assert rows.count() == 9
        assert {r[0] for r in rows.where("`Assessment ID` = '3'").select("Unit").collect()} == {'a|"b"\nc'}


def test_scan_opens_no_file_that_was_not_asked_for(spark, raw):
    (raw / "EXT_MDSAssessmentExtract_Ontario_2024-02-01.csv.gz").write_bytes(b"not gzip" * 10_000)
    manifest = detect_incoming(spark, str(raw), "*.csv")
    rows = scan_all(spark, manifest, source_glob=f"{raw}/*")[S.QUESTIONS].rows
    assert rows.count() == 9


def test_small_splits_share_tasks_and_stay_apart(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("".join(f"line {i}\n" for i in range(5000)))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64")
    try:
        lines = Q.read_lines(spark, [str(path)])
        splits = lines.select("blk").distinct().count()
        assert splits > 500 and lines.rdd.getNumPartitions() < splits / 4
        assert [r[0] for r in lines.orderBy("blk", "mid").select("value").collect()] == [f"line {i}" for i in range(5000)]
        assert lines.select("mid").distinct().count() == 5000
    finally:
        spark.conf.set(key, before)


def test_lines_are_dealt_to_as_many_groups_as_their_size_asks_for(spark, raw):
    from bronzegate.session import TASK_BYTES
    from bronzegate.sources.scan import _groups, _size

    manifest = detect_incoming(spark, str(raw))
    assert _size(manifest) == sum(f.stat().st_size for f in raw.iterdir())
    assert _groups(spark, _size(manifest)) is None
    assert _groups(spark, _size(manifest.withColumn("length", F.lit(TASK_BYTES * 50)))) == 100
    effects = Q.with_effects(Q.read_lines(spark, [str(raw)]))
    want = sorted(Q.states(effects)[0].select("FILE_NAME", "mid", "state", "rec_mid").collect())
    assert sorted(Q.states(effects, 37)[0].select("FILE_NAME", "mid", "state", "rec_mid").collect()) == want


def test_lines_of_files_with_open_quotes_are_placed_once(spark, raw):
    """The parse reads the placed lines, not the raw files, and no pass looks for lines that are records of their own."""
    scans = scan_all(spark, detect_incoming(spark, str(raw)), source_glob=f"{raw}/*", keep_lines=True)
    for et in S.EXTRACT_TYPES:
        assert "Scan text" not in scans[et].stored._jdf.queryExecution().executedPlan().toString()
    want = {et: sorted(map(str, scans[et].rows.collect())) for et in S.EXTRACT_TYPES}
    for f in raw.iterdir():
        f.write_text("")
    for et in S.EXTRACT_TYPES:
        assert scans[et].stored.count() == 9
        assert sorted(map(str, scans[et].stored.collect())) == want[et]


def test_content_hash_is_the_exact_sum(spark, tmp_path):
    from bronzegate.sources.scan import line_stats

    (tmp_path / "a.csv").write_text("".join(f"line {i}|x\n" for i in range(2000)))
    lines = Q.read_lines(spark, [str(tmp_path)])
    want = lines.agg(F.concat_ws(":", F.count(F.lit(1)), F.sum(F.xxhash64("value").cast("decimal(38,0)")))).first()[0]
    assert line_stats(spark, [str(tmp_path)]).first()["content_hash"] == want


def test_stored_lines_are_read_by_few_tasks_and_stay_where_they_are(spark, tmp_path):
    """However small the splits: stored lines share tasks, and meet the states of their splits without being dealt again."""
    folder = tmp_path / "raw"
    folder.mkdir()
    _file(folder / Q_NAME, S.QUESTIONS, 2000)
    _file(folder / S_NAME, S.SCORING, 20)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "128")
    try:
        lines = Q.store_lines(Q.with_effects(Q.read_lines(spark, [str(folder / Q_NAME)])), str(tmp_path / "lines"))
        size = sum(f.stat().st_size for f in (tmp_path / "lines").glob("*.parquet"))
        most = 4 * spark.sparkContext.defaultParallelism
        assert size / 128 > 2 * most and lines.rdd.getNumPartitions() <= most
        scan = scan_all(spark, detect_incoming(spark, str(folder)), source_glob=f"{folder}/*", keep_lines=True)[S.QUESTIONS]
        plan = scan.stored._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert scan.stored.count() == 2000
    finally:
        spark.conf.set(key, before)


def _shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(1 for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_"))


def test_writes_drop_their_shuffle_files(spark, tmp_path):
    from bronzegate.session import stored

    rows = spark.range(0, 1000, 1, 4).selectExpr("id % 7 AS k", "date'2024-01-01' AS FILE_DATE")
    before = _shuffle_files(spark)
    assert stored(rows.groupBy("k").count(), "counts").count() == 7
    B.write_bronze(rows, str(tmp_path / "b"), layout="rebalance")
    assert _shuffle_files(spark) <= before + 8  # the count's own single row


def test_copies_go_when_they_were_read(spark, raw, tmp_path, monkeypatch):
    from pathlib import Path

    from bronzegate.session import checkpoint_root

    root = Path(checkpoint_root(spark).removeprefix("file:")) / "bronzegate"
    held = lambda kind: {p.name for p in root.glob(f"{kind}-*")}
    old, seen, write = held("parsed") | held("lines"), [], B.write_bronze

    def counted(*args, **kwargs):
        seen.append((len(held("parsed") - old), len(held("lines") - old)))
        write(*args, **kwargs)

    monkeypatch.setattr(landing.B, "write_bronze", counted)
    landing.land(spark, str(raw), str(tmp_path / "bronze"), run_ts=dt.datetime(2024, 1, 1))
    assert seen == [(2, 0), (1, 0)] and not (held("parsed") | held("lines")) - old
