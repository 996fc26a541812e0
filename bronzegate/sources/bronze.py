"""Bronze tables, get-or-create, change feeds and the ingestion-log sink.

Tables are Parquet datasets (a format parameter allows any file source the
session supports, e.g. ``delta`` when its package is installed), partitioned
by ``FILE_DATE``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..session import dropped_shuffles

BATCH_COLUMN = "INGEST_BATCH_ID"
#: What the log keeps of a file besides its fixed columns, to tell versions apart.
VERSION_COLUMNS = ("FILE_LENGTH", "FILE_MODIFIED", "CONTENT_HASH")


def table_path(bronze_dir: str, extract_type: str) -> str:
    return f"{bronze_dir.rstrip('/')}/{extract_type}"


def log_path(bronze_dir: str) -> str:
    return f"{bronze_dir.rstrip('/')}/_ingestion_log"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None when there is none yet."""
    try:
        r = spark.read.format(fmt)
        if schema is not None:
            r = r.schema(schema)
        if fmt == "parquet":
            r = r.option("mergeSchema", True)
        return r.load(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


LAYOUTS = ("as_read", "rebalance")


def write_bronze(df: DataFrame, path: str, mode: str = "append", partition_by: str | list[str] = "FILE_DATE",
                 fmt: str = "parquet", layout: str = "as_read") -> None:
    """Append or overwrite, partitioned by FILE_DATE (and the batch, where rows carry one).

    Rows with a batch id are appended by replacing exactly the (FILE_DATE, batch) folders they
    belong to, so writing a batch again after a crash leaves its rows once. Overwrite
    replaces the WHOLE table (static partition-overwrite mode), matching one overwrite per batch.

    ``layout="rebalance"`` shuffles the rows by FILE_DATE before the write, with adaptive splitting of
    large dates and merging of small ones: files follow the size of a date, not the number
    of tasks that held some of it. ``as_read`` writes them where they were parsed, without a shuffle.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', got {mode!r}")
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    if layout == "rebalance":
        df = df.hint("rebalance", *[F.col(c) for c in parts])
    keyed = BATCH_COLUMN in df.columns
    w = df.write.format(fmt).partitionBy(*parts, *([BATCH_COLUMN] if keyed else []))
    if mode == "overwrite":
        w = w.mode("overwrite").option("partitionOverwriteMode", "static")
    elif keyed:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    with dropped_shuffles(df.sparkSession):
        w.save(path)


def _write_batch(df: DataFrame, path: str) -> None:
    """Append a batch's rows under its own folder; the same batch again replaces them."""
    with dropped_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COLUMN).parquet(path)


def get_or_create_table(spark: SparkSession, path: str, for_data: DataFrame | None = None,
                        schema: T.StructType | None = None, name: str | None = None,
                        partition_by: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """Open the table at ``path``; create it empty when absent.

    The explicit ``schema`` wins over ``for_data``'s schema; neither -> ValueError.
    ``name`` additionally registers a temporary view.
    """
    if schema is None and for_data is None:
        raise ValueError("Either `for_data` or `schema` must be provided")
    schema = schema if schema is not None else for_data.schema
    existing = read_table(spark, path, fmt)
    if existing is None:
        empty = spark.createDataFrame([], schema)
        w = empty.write.format(fmt).mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(path)
        existing = spark.read.format(fmt).load(path)
        if partition_by:
            # Re-apply the declared column order (partition columns come last on read).
            existing = existing.select(*[F.col(f"`{f.name}`") for f in schema.fields])
    if name:
        existing.createOrReplaceTempView(name)
    return existing


def change_feed(table: DataFrame, from_batch: int = 0, to_batch: int | None = None) -> DataFrame:
    """S7(a): rows appended by batches ``from_batch..to_batch`` (inclusive, None = latest).

    Every landed row carries the batch ID of the run that wrote it, so the
    feed is a pushed-down range filter on that column plus a change type.
    """
    cond = F.col(BATCH_COLUMN) >= F.lit(from_batch)
    if to_batch is not None:
        cond = cond & (F.col(BATCH_COLUMN) <= F.lit(to_batch))
    return (table.where(cond).withColumn("_change_type", F.lit("insert"))
            .withColumn("_commit_version", F.col(BATCH_COLUMN)))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """S7(b): multiset difference of two snapshots, duplicates counted, in one aggregation.

    Each snapshot is read once: rows count +1 in ``new`` and -1 in ``old``, and equal rows cancel
    before the shuffle's result. Without ``keys`` the rest are inserts and deletes. With
    ``keys`` the rest is matched per key: the n-th row that went and the n-th that came (in order
    of their values) are the ``update_preimage`` and ``update_postimage`` of one change, and what
    is over is ``delete`` or ``insert``. Keys compare null-safe; only changed rows reach that step.
    """
    columns = list(new.columns)
    if set(old.columns) != set(columns):
        raise ValueError("both snapshots need the same columns")
    sided = new.withColumn("_sign", F.lit(1)).unionByName(old.withColumn("_sign", F.lit(-1)))
    cols = [F.col(f"`{c}`") for c in columns]
    net = sided.groupBy(*cols).agg(F.sum("_sign").alias("_net")).where("_net <> 0")
    rows = net.withColumn("_came", F.col("_net") > 0).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.abs("_net").cast("int"))))
    if not keys:
        kind = F.when(F.col("_came"), F.lit("insert")).otherwise(F.lit("delete"))
        return rows.select(*cols, kind.alias("_change_type"))
    by = [F.col(f"`{k}`") for k in keys]
    rest = [F.col(f"`{c}`") for c in columns if c not in keys]
    nth = F.row_number().over(Window.partitionBy(*by, "_came").orderBy(*rest, "_copy"))
    came = F.sum(F.when(F.col("_came"), 1).otherwise(0)).over(Window.partitionBy(*by))
    went = F.sum(F.when(F.col("_came"), 0).otherwise(1)).over(Window.partitionBy(*by))
    kind = (F.when(F.col("_came"), F.when(F.col("_nth") <= F.col("_went"), "update_postimage").otherwise("insert"))
            .otherwise(F.when(F.col("_nth") <= F.col("_all_came"), "update_preimage").otherwise("delete")))
    return rows.withColumns({"_nth": nth, "_all_came": came, "_went": went}).select(*cols, kind.alias("_change_type"))


def append_log(log: DataFrame, bronze_dir: str) -> None:
    """Append the run's rows to the Parquet ingestion-log table (once per batch)."""
    _write_batch(log, log_path(bronze_dir))


def unpaired_path(bronze_dir: str) -> str:
    return f"{bronze_dir.rstrip('/')}/_unpaired"


def null_report_path(bronze_dir: str) -> str:
    return f"{bronze_dir.rstrip('/')}/_null_report"


def append_null_report(report: DataFrame, bronze_dir: str) -> None:
    """P9 sink: (FILE_NAME, column_name, nulls, n, severity, batch) per run."""
    _write_batch(report, null_report_path(bronze_dir))


def read_log(spark: SparkSession, bronze_dir: str) -> DataFrame | None:
    return read_table(spark, log_path(bronze_dir))


def export_log_csv(log: DataFrame, out_dir: str, run_ts_text: str) -> str:
    """CSV copy of a run's log named ``INGESTION_AT_<yyyy-MM-dd_HH-mm>``; arrays as JSON text."""
    path = f"{out_dir.rstrip('/')}/INGESTION_AT_{run_ts_text}"
    flat = log.select(*[F.to_json(F.col(c)).alias(c) if c in ("READ_ERRORS", "INGEST_ERRORS") else F.col(c)
                        for c in log.columns])
    flat.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def _landed(log: DataFrame) -> DataFrame:
    """The latest successful version of each file: FILE_NAME, batch and what identifies its content."""
    about = [c for c in VERSION_COLUMNS if c in log.columns]
    best = log.where(F.col("INGEST_SUCCESS")).groupBy("FILE_NAME").agg(
        F.max(F.struct(BATCH_COLUMN, *about)).alias("v"))
    return best.select("FILE_NAME", "v.*")


def read_committed(spark: SparkSession, bronze_dir: str, extract_type: str, fmt: str = "parquet",
                   max_broadcast_rows: int = 1_000_000) -> DataFrame | None:
    """Bronze rows of runs that completed: of each file, those of its latest batch the log lists as ingested.

    The log is written last, so rows of a run that died between the two table
    writes (or before its log) are invisible here, and a rerun that lands the
    same files again does not double them. A file delivered again with other
    content supersedes its earlier version.
    """
    table = read_table(spark, table_path(bronze_dir, extract_type), fmt)
    log = read_log(spark, bronze_dir)
    if table is None or log is None:
        return None
    done = _landed(log).select("FILE_NAME", BATCH_COLUMN)
    n = done.count()  # one row per landed file: a proven bound for the broadcast
    done = F.broadcast(done) if n <= max_broadcast_rows else done
    return table.join(done, ["FILE_NAME", BATCH_COLUMN], "left_semi")


def ingested_files(spark: SparkSession, bronze_dir: str, fmt: str = "parquet") -> DataFrame | None:
    """Files whose rows the table still holds: FILE_NAME, batch, FILE_LENGTH, FILE_MODIFIED, CONTENT_HASH.

    An overwrite removes all earlier batches, and batch ids grow, so a logged file
    counts only if its batch is not before the oldest one in the table.
    """
    log = read_log(spark, bronze_dir)
    table = read_table(spark, table_path(bronze_dir, S.QUESTIONS), fmt)
    if log is None or table is None:
        return None
    oldest = table.agg(F.min(BATCH_COLUMN).alias("oldest"))  # one row
    done = _landed(log).join(F.broadcast(oldest), F.col(BATCH_COLUMN) >= F.col("oldest"))
    return done.drop("oldest")


__all__ = [
    "BATCH_COLUMN", "table_path", "log_path", "read_table", "write_bronze", "get_or_create_table",
    "change_feed", "snapshot_diff", "append_log", "read_log", "export_log_csv", "ingested_files",
    "read_committed", "null_report_path", "append_null_report", "S",
]
