"""The end-to-end landing job, composed from the operators.

    detect (S1,P1,F1) -> pair (J1) -> skip unchanged files -> scan (S2-S4) -> conform (P2-P8)
      -> rollups (E1,P9) + per-pair ID check (E3) -> outcome (E6)
      -> gate (F3) -> write Questions, then Scoring (S5) -> log (S8) + null report (P9)
    -> archive (F4,S9)

Rows are parsed once: they are stored as Parquet under the shared checkpoint folder, the checks
read a narrow projection of them (keys and failure flags), the write the rows of the files that pass, and the
copy of a type is removed when its table is written. With ``persist=False`` no copy is made and every step parses
again. Rows never pass through the driver.

A file is a version: name, length, modification time and content hash. An append leaves out pairs
whose files are as the log knows them (``skipped`` log rows); a file delivered again with
other content is landed as a new version, which supersedes the earlier one in committed reads.

Every write of a run goes to folders of its batch id and replaces them, so a run repeated under
the same ``batch_id`` (a replayed micro-batch) leaves each row once.
"""

from __future__ import annotations

import datetime as _dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.conform import conform, flag_columns, without_flags
from ..operators.records import (
    file_read_metadata,
    file_rollup,
    ingest_outcome,
    ingestion_log,
    null_report,
    pair_files,
    pair_id_check,
    uncovered_ids,
    unpaired_outcome,
)
from ..session import SCRATCH, broadcast_if_small, compiled_methods, cut_lineage, delete_dir, dropped_shuffles, shared_dir, stored
from ..sources import archive as A
from ..sources import bronze as B
from ..sources.discover import detect_incoming, name_errors
from ..sources.scan import scan_all

MAX_BROADCAST_FILES = 1_000_000  # per-file tables: a row is ~100 bytes


SKIPPED = "skipped: already ingested, content unchanged"


@dataclass
class LandingResult:
    log: DataFrame
    null_report: DataFrame | None = None
    id_check: DataFrame | None = None
    disposition: DataFrame | None = None
    uncovered: DataFrame | None = None   # J3, lazy: IDs one file of a pair holds and the other lacks
    batch_id: int = 0
    written: dict = field(default_factory=dict)


def _validate(mode, archive_dir, archive_behaviour, on_unpaired, on_unequal):
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', got {mode!r}")
    if archive_behaviour is not None and not archive_dir:
        raise ValueError("archive_dir is required when archive_behaviour is set")
    if on_unpaired not in ("fail", "quarantine"):
        raise ValueError("on_unpaired must be 'fail' or 'quarantine'")
    if on_unequal not in ("record", "skip"):
        raise ValueError("on_unequal must be 'record' or 'skip'")


def _narrow(conformed: DataFrame) -> DataFrame:
    """What the rollup and the ID check read of the parsed rows."""
    keys = ["FILE_NAME", S.RESIDENT_COLUMN, S.FACILITY_COLUMN, S.ID_COLUMN, *flag_columns(conformed)]
    return conformed.select(*[F.col(f"`{c}`") for c in keys])


def prepare(spark: SparkSession, manifest: DataFrame, run_ts: _dt.datetime, persist: bool = True,
            skip_blank: bool = False, source_glob: str | None = None, n_files: int | None = None):
    """Scan + conform both extract types.

    Returns (conformed by type, narrow by type, status, rollup, full rollups, parsed by type, folder by type); with ``persist``
    ``conformed`` and ``narrow`` read the stored rows in the folder, ``parsed`` is the narrow frame before it.
    """
    conformed, narrow, statuses, rollups, full_rollups, parsed, folders = {}, {}, [], [], {}, {}, {}
    by_type = scan_all(spark, manifest, skip_blank=skip_blank, source_glob=source_glob, n_files=n_files,
                       with_metadata=True, keep_lines=persist)
    for et in S.EXTRACT_TYPES:
        scan = by_type[et]
        statuses.append(scan.status)
        if scan.rows is None:
            if scan.folder:
                delete_dir(spark, scan.folder)
            continue
        conformed[et] = conform(scan.rows, et, run_ts, with_metadata=True)
        parsed[et] = _narrow(conformed[et])
        if persist:
            folders[et] = shared_dir(spark, "parsed")
            once = conform(scan.stored, et, run_ts, with_metadata=True) if scan.stored is not None else conformed[et]
            with compiled_methods(spark), dropped_shuffles(spark):
                once.write.options(**SCRATCH).parquet(folders[et])
            if scan.folder:
                delete_dir(spark, scan.folder)
            conformed[et] = spark.read.schema(conformed[et].schema).parquet(folders[et])
        n = narrow[et] = _narrow(conformed[et])
        # One small row per file.
        full = stored(file_rollup(n), "rollup")
        full_rollups[et] = full
        rollups.append(full.select("FILE_NAME", "N_ROWS", "N_RESIDENTS", "N_FACILITIES",
                                   "N_UNIQUE_ASSESSMENTS", "value_errors"))
    status = statuses[0].unionByName(statuses[1])
    if rollups:
        rollup = rollups[0] if len(rollups) == 1 else rollups[0].unionByName(rollups[1])
    else:
        rollup = spark.createDataFrame([], "FILE_NAME string, N_ROWS bigint, N_RESIDENTS bigint, "
                                           "N_FACILITIES bigint, N_UNIQUE_ASSESSMENTS bigint, "
                                           "value_errors array<string>")
    return conformed, narrow, status, rollup, full_rollups, parsed, folders


def _skipped(pairs: DataFrame, unchanged: DataFrame) -> DataFrame:
    """Files (FILE_NAME) of the pairs whose two files are both unchanged."""
    q = unchanged.select(F.col("FILE_NAME").alias("Q_FILE"))
    s = unchanged.select(F.col("FILE_NAME").alias("S_FILE"))
    both = pairs.where(F.col("PAIR_STATUS") == "PAIRED").join(q, "Q_FILE", "left_semi").join(s, "S_FILE", "left_semi")
    return both.select(F.explode(F.array("Q_FILE", "S_FILE")).alias("FILE_NAME"))


def _skipped_outcome(files: DataFrame) -> DataFrame:
    return files.select(F.array(F.lit(SKIPPED)).alias("INGEST_ERRORS"), F.lit(False).alias("INGEST_SUCCESS"), "FILE_NAME")


def _empty_rows(spark: SparkSession, et: str) -> DataFrame:
    return spark.createDataFrame([], S.bronze_schema(et))


def land(spark: SparkSession, raw_dir: str, bronze_dir: str, file_glob: str = S.DEFAULT_GLOB,
         filters=None, mode: str = "append", archive_dir: str | None = None,
         archive_behaviour=None, archive_err_behaviour=S.DEFAULT_ARCHIVE_ERR_BEHAVIOUR,
         compression: str | None = S.DEFAULT_ARCHIVE_CODEC, on_unpaired: str = "fail",
         on_unequal: str = "record", run_ts: _dt.datetime | None = None, persist: bool = True,
         fmt: str = "parquet", manifest: DataFrame | None = None, export_csv_dir: str | None = None,
         skip_blank: bool = False, scan_glob: str | None = None, batch_id: int | None = None,
         layout: str = "as_read") -> LandingResult:
    """Land every paired extract in ``raw_dir`` into ``bronze_dir``.

    Parameters mirror the original job (``raw_dir, bronze_dir, file_glob,
    filters, mode, archive_dir, archive_behaviour, archive_err_behaviour,
    compression``) and are validated before anything runs. Appends are
    idempotent: pairs the log records as ingested with the same content are skipped.
    ``manifest`` lets a caller (the streaming job) pass its own file set, ``batch_id`` its own
    identity of the run (a later run needs a greater one).
    A file whose name does not give a date, an instance and a province fails, unread, with its pair.
    ``skip_blank`` drops the one-empty-field rows blank lines give in a
    tolerant parse; ``on_unequal="skip"`` withholds pairs whose ID sets differ.
    Unpaired files fail the run (they are listed in ``<bronze_dir>/_unpaired``) or are logged.
    ``layout`` is that of ``write_bronze``.
    """
    _validate(mode, archive_dir, archive_behaviour, on_unpaired, on_unequal)
    run_ts = run_ts or _dt.datetime.now().replace(microsecond=0)
    # Unique per run (microseconds at start), also when runs share a run_ts.
    batch_id = time.time_ns() // 1000 if batch_id is None else batch_id

    if manifest is None:
        manifest = detect_incoming(spark, raw_dir, file_glob, filters)
        scan_glob = f"{raw_dir.rstrip('/')}/{file_glob}"
    for c, t in (("length", "long"), ("modificationTime", "timestamp")):
        if c not in manifest.columns:
            manifest = manifest.withColumn(c, F.lit(None).cast(t))
    manifest = cut_lineage(manifest.select(*S.FILE_METADATA_COLUMNS, "path", "length", "modificationTime",
                                           name_errors().alias("name_error")))
    n_files = manifest.count()

    def sized(df: DataFrame) -> DataFrame:
        return broadcast_if_small(df, MAX_BROADCAST_FILES, n_files)

    pairs = cut_lineage(pair_files(manifest))
    unpaired = pairs.where(F.col("PAIR_STATUS") == "UNPAIRED").select(F.coalesce("Q_FILE", "S_FILE").alias("FILE_NAME"))
    if on_unpaired == "fail":
        n_bad = unpaired.count()
        if n_bad:
            unpaired.write.mode("overwrite").parquet(B.unpaired_path(bronze_dir))
            some = [r[0] for r in unpaired.orderBy("FILE_NAME").limit(50).collect()]
            raise ValueError(f"Questions and Scoring files are not paired: {n_bad} file(s), all listed in "
                             f"{B.unpaired_path(bronze_dir)}; the first are {some}")
    known = B.ingested_files(spark, bronze_dir, fmt) if mode == "append" else None
    none = manifest.select("FILE_NAME").limit(0)
    unread = none  # pairs as the log knows them by length and modification time
    if known is not None:
        known = cut_lineage(known)
        same = manifest.join(known.drop(B.BATCH_COLUMN), "FILE_NAME").where(
            (F.col("length") == F.col("FILE_LENGTH")) & (F.col("modificationTime") == F.col("FILE_MODIFIED")))
        unread = cut_lineage(_skipped(pairs, same.select("FILE_NAME")))
    paired_names = pairs.where(F.col("PAIR_STATUS") == "PAIRED").select(
        F.explode(F.array("Q_FILE", "S_FILE")).alias("FILE_NAME"))
    to_read = manifest.where("name_error IS NULL").join(sized(paired_names), "FILE_NAME", "left_semi").join(
        sized(unread), "FILE_NAME", "left_anti")

    conformed, narrow, status, rollup, full_rollups, parsed, folders = prepare(spark, to_read, run_ts, persist, skip_blank, scan_glob)
    bad_names = manifest.where("name_error IS NOT NULL").select(
        "FILE_NAME", F.lit("unreadable").alias("route"), F.array("name_error").alias("read_errors"), F.lit(False).alias("readable"),
        F.lit(None).cast("string").alias("content_hash"))
    status = status.unionByName(bad_names)
    read_meta = file_read_metadata(status, rollup)
    q, s = narrow.get(S.QUESTIONS), narrow.get(S.SCORING)
    uncovered = None
    if q is not None and s is not None:
        id_check = pair_id_check(q, s)
        # Lazy, and read after the stored rows are gone.
        uncovered = uncovered_ids(parsed[S.QUESTIONS], parsed[S.SCORING], pairs, n_pairs=n_files)
    else:
        id_check = spark.createDataFrame([], "PAIR_KEY string, relation string")
    skipped = unread
    if known is not None:  # read because of another time or length, yet the same content
        hashes = status.select("FILE_NAME", F.col("content_hash").alias("now")).join(known, "FILE_NAME").where("now = CONTENT_HASH")
        skipped = cut_lineage(_skipped(pairs, hashes.select("FILE_NAME").unionByName(unread)).unionByName(unread).distinct())
    outcome = ingest_outcome(pairs, read_meta, id_check, on_unequal == "skip")
    outcome = outcome.join(sized(skipped), "FILE_NAME", "left_anti").unionByName(_skipped_outcome(skipped))
    if on_unpaired == "quarantine":
        outcome = outcome.unionByName(unpaired_outcome(pairs))
    processed = F.lit(run_ts).cast("timestamp_ntz")
    log = ingestion_log(manifest, read_meta, outcome, processed)
    about = manifest.select("FILE_NAME", F.col("length").alias("FILE_LENGTH"), F.col("modificationTime").alias("FILE_MODIFIED"))
    log = log.join(sized(about), "FILE_NAME").join(status.select("FILE_NAME", F.col("content_hash").alias("CONTENT_HASH")), "FILE_NAME", "left")
    log = log.withColumn(B.BATCH_COLUMN, F.lit(batch_id).cast("long"))
    # The gate is computed once and its lineage cut, so both writes and the log agree.
    log = stored(log, "log")

    passing = sized(log.where(F.col("INGEST_SUCCESS")).select("FILE_NAME"))
    written = {}
    # An overwrite replaces the tables only by files that passed, never by nothing.
    kept = mode == "overwrite" and log.where(F.col("INGEST_SUCCESS")).isEmpty()
    for et in () if kept else (S.QUESTIONS, S.SCORING):  # Questions first: Scoring only follows a written Questions file
        rows = conformed.get(et)
        rows = without_flags(rows).join(passing, "FILE_NAME", "left_semi") if rows is not None \
            else _empty_rows(spark, et)
        rows = rows.withColumn(B.BATCH_COLUMN, F.lit(batch_id).cast("long"))
        B.write_bronze(rows, B.table_path(bronze_dir, et), mode, fmt=fmt, layout=layout)
        written[et] = B.table_path(bronze_dir, et)
        if et in folders:
            delete_dir(spark, folders.pop(et))
    B.append_log(log, bronze_dir)
    if export_csv_dir:
        B.export_log_csv(log, export_csv_dir, run_ts.strftime("%Y-%m-%d_%H-%M"))

    # Per file and string column, missing values before the fill.
    nulls = None
    for r in full_rollups.values():
        nr = null_report(r)
        nulls = nr if nulls is None else nulls.unionByName(nr)
    if nulls is not None:
        nulls = nulls.withColumn(B.BATCH_COLUMN, F.lit(batch_id).cast("long"))
        B.append_null_report(nulls, bronze_dir)

    plan = None
    if archive_behaviour is not None:
        plan = A.disposition(log, archive_behaviour, archive_err_behaviour, run_ts.strftime("%Y-%m-%d_%H-%M"))
        A.apply_disposition(spark, plan, manifest, archive_dir, compression)

    for folder in folders.values():
        delete_dir(spark, folder)
    return LandingResult(log=log, null_report=nulls, id_check=id_check, disposition=plan, uncovered=uncovered,
                         batch_id=batch_id, written=written)
