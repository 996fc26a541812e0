"""F4 disposition of raw files after a run, S10 pre-check and S9 cold archive.

The archive is a Parquet dataset of chunks: one row per ``CHUNK_BYTES`` of a file (name, chunk number,
offset, content, SHA-256 of the chunk) and, per file, its length and the SHA-256 over its chunk hashes.
Chunks are read from the shared file system by many tasks, whatever the size of a file, and none of them holds
more than a few chunks at a time. It is
checked by reading sources and archive again before any source file is removed. Moves are
file-system renames issued through the Hadoop FileSystem API, so they work on
shared storage.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import nonempty
from ..session import SCRATCH, TASK_BYTES, broadcast_if_small, cut_lineage, delete_dir, dropped_shuffles, hadoop_fs, shared_dir, stored, together

#: Accepted names of the Parquet codecs the archive can be written with.
CODECS = {"gzip": "gzip", "gz": "gzip", "zstd": "zstd", "snappy": "snappy", "none": "none", None: "none"}
CHUNK_BYTES = 32 << 20
#: Files are archived in groups of about so many bytes, so the disk holds the shuffle of one group at a time.
GROUP_BYTES = 4 << 30
#: Where a group has at most so many files they are named to the scan, which opens no other.
MAX_NAMED_FILES = 4096
#: Files and chunks (a row of about 200 bytes each) whose places are broadcast to the lines.
MAX_BROADCAST = 250_000


def codec_of(compression: str | None) -> str:
    """The Parquet codec of a compression name; there is none for xz and bzip2, so these are errors."""
    if compression not in CODECS:
        raise ValueError(f"unknown compression {compression!r}; the archive can be written with {sorted(str(c) for c in CODECS)}")
    return CODECS[compression]


def _target(behaviour) -> tuple[Column, Column]:
    if behaviour is None:
        return F.lit("stay"), F.lit(None).cast("string")
    kind, name = behaviour
    if kind not in ("move", "tarball"):
        raise ValueError(f"unknown archive behaviour {behaviour!r}")
    return F.lit("move" if kind == "move" else "archive"), F.lit(name)


def disposition(log: DataFrame, behaviour=("tarball", "ingested"), err_behaviour=("move", "ingested-review"),
                timestamp: str = "", joiner: str = "_") -> DataFrame:
    """(FILE_NAME, action, destination) for every logged file.

    Not ingested -> stay. Ingested without errors -> ``behaviour``. Ingested
    with read or ingest errors -> ``err_behaviour`` (``"include"`` = same as
    clean files, ``None`` = stay). ``behaviour=None`` leaves every file in place.
    Destinations are ``<name><joiner><timestamp>``.
    """
    if behaviour is None:
        return log.select("FILE_NAME", F.lit("stay").alias("action"),
                          F.lit(None).cast("string").alias("destination"))
    ok_action, ok_dest = _target(behaviour)
    if err_behaviour == "include":
        err_action, err_dest = ok_action, ok_dest
    else:
        err_action, err_dest = _target(err_behaviour)
    has_err = nonempty(F.col("READ_ERRORS")) | nonempty(F.col("INGEST_ERRORS"))
    action = (F.when(~F.col("INGEST_SUCCESS"), F.lit("stay"))
               .when(has_err, err_action).otherwise(ok_action))
    dest = (F.when(~F.col("INGEST_SUCCESS"), F.lit(None).cast("string"))
             .when(has_err, err_dest).otherwise(ok_dest))
    dest = F.when(dest.isNotNull(), F.concat(dest, F.lit(joiner + timestamp) if timestamp else F.lit("")))
    return log.select("FILE_NAME", action.alias("action"), dest.alias("destination"))


def _base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _grouped(files: DataFrame) -> list[DataFrame]:
    """The files (path, length) in groups of about ``GROUP_BYTES``, by path; a file is in one group."""
    before = F.sum("length").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    dealt = cut_lineage(files.select("path", "length", F.floor(before / F.lit(GROUP_BYTES)).alias("g")))  # a row a file
    return [dealt.where(F.col("g") == r[0]).drop("g") for r in dealt.select("g").distinct().orderBy("g").collect()]


def missing_files(requested: DataFrame, listing: DataFrame, key: str = "FILE_NAME") -> DataFrame:
    """Requested names that are not regular files in the listing (left anti join)."""
    return requested.select(key).join(listing.select(key), key, "left_anti")


def list_parents(spark: SparkSession, requested: DataFrame, key: str = "path") -> DataFrame:
    """(path, is_file) of everything in the folders that the requested paths are in: one listing per folder."""
    folders = [r[0] for r in requested.select(F.regexp_replace(key, "/[^/]*$", "").alias("f")).distinct().collect()]
    rows = []
    for folder in folders:
        fs, at = hadoop_fs(spark, folder)
        if fs.exists(at) and fs.getFileStatus(at).isDirectory():
            rows += [(st.getPath().toString(), bool(st.isFile()), int(st.getLen())) for st in fs.listStatus(at)]
    return spark.createDataFrame(rows, "path string, is_file boolean, length long")


def _plain(path: Column) -> Column:
    """A path without its scheme and authority, to compare listings with what a caller wrote."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def precheck_report(requested: DataFrame, listing: DataFrame) -> DataFrame:
    """(path, reason) of every requested path that is missing or not a regular file."""
    held = listing.select(_plain(F.col("path")).alias("at"), "is_file")
    j = requested.select("path", _plain(F.col("path")).alias("at")).distinct().join(held, "at", "left")
    reason = (F.when(F.col("is_file").isNull(), F.lit("file does not exist."))
              .when(~F.col("is_file"), F.lit("path does not point to a file.")))
    return j.select("path", reason.alias("reason")).where("reason IS NOT NULL")


def precheck(spark: SparkSession, paths: Sequence[str]) -> None:
    """S10 before anything is touched: every path must exist and be a regular file."""
    requested = spark.createDataFrame([(p,) for p in paths], "path string")
    bad = precheck_report(requested, list_parents(spark, requested)).orderBy("path").limit(1).collect()
    for r in bad:
        kind = FileNotFoundError if "exist" in r["reason"] else ValueError
        raise kind(f"attempt to archive {r['path']}, but {r['reason']}")


def read_chunks(spark: SparkSession, files: DataFrame, chunk_bytes: int | None = None) -> tuple[DataFrame, str]:
    """(path, length, chunk, offset, content, sha256) of the files (path, length), byte for byte, and the folder it is read from.

    A chunk is a run of lines of one split, of about ``chunk_bytes`` (``CHUNK_BYTES``; more only if a single line is longer). The
    length tells what reading by lines leaves out: whether the last line ended with a line feed and whether the file began
    with a byte order mark. Lines are read and moved once; the caller deletes the folder.
    """
    chunk_bytes = chunk_bytes or CHUNK_BYTES
    folders = [r[0] for r in files.select(F.regexp_replace("path", "/[^/]*$", "").alias("f")).distinct().collect()]
    wanted = files.select("path", "length", _plain(F.col("path")).alias("at"))
    folder, split = shared_dir(spark, "chunks"), ["at", "blk"]
    with _chunk_splits(spark, max(chunk_bytes, CHUNK_BYTES), chunk_bytes), dropped_shuffles(spark):
        text = spark.read.format("text").option("lineSep", "\n").load(folders)
        n_files = files.count()
        if n_files <= MAX_NAMED_FILES:
            text = text.where(F.col("_metadata.file_name").isin([r[0] for r in files.select(_base_name(F.col("path"))).distinct().collect()]))
        lines = together(text.select(
            _plain(F.col("_metadata.file_path")).alias("at"), F.col("_metadata.file_block_start").alias("blk"),
            F.monotonically_increasing_id().alias("mid"), "value"))
        # Not a semi join, which would be moved to below ``together`` and set up once a split.
        lines = lines.join(broadcast_if_small(wanted.select("at").distinct(), MAX_BROADCAST, n_files), "at")
        size, part = F.octet_length("value") + 1, F.lit(0).cast("long")
        if chunk_bytes < CHUNK_BYTES:
            earlier = Window.partitionBy(*split).orderBy("mid").rowsBetween(Window.unboundedPreceding, -1)
            part = F.floor(F.coalesce(F.sum(size).over(earlier), F.lit(0)) / F.lit(chunk_bytes))
        pieces = lines.withColumn("part", part).groupBy(*split, "part").agg(
            F.sum(size).alias("bytes"), F.array_sort(F.collect_list(F.struct("mid", "value"))).alias("lines"))
        pieces = pieces.select(*split, "part", "bytes", F.array_join("lines.value", "\n").alias("text"))
        pieces.write.options(**SCRATCH).parquet(folder)
    pieces = spark.read.schema(pieces.schema).parquet(folder)
    # What needs a file's other chunks is told from their sizes, a row a chunk.
    w = Window.partitionBy("at").orderBy("blk", "part")
    places = pieces.select(*split, "part", "bytes").withColumns({
        "chunk": F.row_number().over(w) - 1, "before": F.coalesce(F.sum("bytes").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "total": F.sum("bytes").over(Window.partitionBy("at"))})
    places = cut_lineage(wanted.join(places, "at", "left").withColumn("chunk", F.coalesce("chunk", F.lit(0)).cast("long")))
    held = places.where("blk IS NOT NULL")
    held = F.broadcast(held) if held.count() <= MAX_BROADCAST else held.hint("shuffle_hash")
    j = pieces.drop("bytes").join(held, [*split, "part"])
    j = j.unionByName(places.where("blk IS NULL").withColumn("text", F.lit(None).cast("string")))
    marked = F.coalesce(F.col("length") - F.col("total") >= 2, F.lit(False))
    open_end = F.coalesce((F.col("before") + F.col("bytes") == F.col("total")) & (F.col("length") - F.when(marked, 3).otherwise(0) < F.col("total")), F.lit(False))
    body = F.when(open_end, F.col("text")).otherwise(F.concat("text", F.lit("\n"))).cast("binary")
    mark = F.unhex(F.lit("EFBBBF"))
    content = F.coalesce(F.when(marked & (F.col("chunk") == 0), F.concat(mark, body)).otherwise(body),
                         F.when(F.col("length") == 3, mark).otherwise(F.lit(b"")))  # no line at all: empty, or only a mark
    offset = F.when(F.col("chunk") == 0, F.lit(0)).otherwise(F.col("before") + F.when(marked, 3).otherwise(0))
    out = j.select("path", "length", "chunk", offset.cast("long").alias("offset"), content.alias("content")).withColumn("sha256", F.sha2("content", 256))
    return out, folder


def _hashes(chunks: DataFrame, key: str, *more: Column) -> DataFrame:
    """Per file: how many chunks, how many bytes, and the hash over the chunk hashes in order (and ``more`` aggregates)."""
    seen = F.array_sort(F.collect_list(F.struct("chunk", "sha256")))
    per_file = chunks.groupBy(key).agg(seen.alias("seen"), F.sum(F.octet_length("content")).alias("bytes"), *more)
    return per_file.withColumns({"chunks": F.size("seen"), "file_sha256": F.sha2(F.array_join("seen.sha256", ""), 256)}).drop("seen")


@contextmanager
def _chunk_splits(spark: SparkSession, split_bytes: int, chunk_bytes: int):
    """While active, scans are split at ``split_bytes``, so a chunk is the same part of a split each time; a task puts its
    chunks of up to ``TASK_BYTES`` together by hash, more of them sorted."""
    conf = {"spark.sql.files.maxPartitionBytes": split_bytes,
            "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": max(2 * TASK_BYTES // chunk_bytes, 2)}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def archive_files(spark: SparkSession, paths: Sequence[str], dest: str, compression: str | None = "gzip",
                  retain_structure: bool = False, remove_sources: bool = False, chunk_bytes: int | None = None) -> str:
    """Bundle ``paths`` into a Parquet archive at ``dest`` and verify it.

    Chunks are of about ``chunk_bytes`` (``CHUNK_BYTES``). ``retain_structure`` keeps the full source path, else the base name only.
    Sources are deleted only after every re-read hash matches.
    """
    codec = codec_of(compression)
    paths = list(paths)
    precheck(spark, paths)
    requested = spark.createDataFrame([(p,) for p in paths], "path string").distinct()
    listing = list_parents(spark, requested).select(_plain(F.col("path")).alias("at"), "length")
    files = cut_lineage(requested.withColumn("at", _plain(F.col("path"))).join(listing, "at").select("path", "length"))
    name = F.col("path") if retain_structure else _base_name(F.col("path"))
    for i, some in enumerate(_grouped(files) or [files]):
        chunks, folder = read_chunks(spark, some, chunk_bytes)
        with dropped_shuffles(spark):
            chunks.withColumn("name", name).write.mode("append" if i else "errorifexists").option("compression", codec).parquet(dest)
        delete_dir(spark, folder)
    verify_archive(spark, files, dest, chunk_bytes)
    if remove_sources:
        for p in paths:
            fs, jp = hadoop_fs(spark, p)
            if not fs.delete(jp, False):
                raise IOError(f"{p} is archived in {dest} but could not be removed")
    return dest


def verify_archive(spark: SparkSession, files: DataFrame, dest: str, chunk_bytes: int | None = None) -> None:
    """Read archive and sources again: the same chunks with the same content, of the files' full length."""
    source = []
    for some in _grouped(files) or [files]:
        chunks, folder = read_chunks(spark, some, chunk_bytes)
        source.append(stored(_hashes(chunks, "path"), "hashes"))
        delete_dir(spark, folder)
    source = reduce(DataFrame.unionByName, source)
    kept = spark.read.parquet(dest).withColumn("now", F.sha2("content", 256))
    broken = F.sum(F.when(F.col("now") != F.col("sha256"), 1).otherwise(0))
    archived = stored(_hashes(kept, "path", broken.alias("broken")), "hashes")
    broken = archived.agg(F.coalesce(F.sum("broken"), F.lit(0))).first()[0]
    want = files.join(source, "path").select("path", "length", "chunks", "file_sha256")
    short = want.join(archived.withColumnRenamed("bytes", "length"), ["path", "length", "chunks", "file_sha256"], "left_anti").count()
    if broken or short:
        raise IOError(f"archive {dest} does not match its sources ({broken} chunk(s), {short} file(s))")


def archived_files(spark: SparkSession, dest: str) -> DataFrame:
    """(name, length, chunks, file_sha256) of an archive."""
    kept = spark.read.parquet(dest)
    return kept.select("name", "length").distinct().join(_hashes(kept, "name"), "name")


def move_files(spark: SparkSession, paths: Sequence[str], dest_dir: str) -> str:
    """Rename every path into ``dest_dir`` after the pre-check."""
    paths = list(paths)
    precheck(spark, paths)
    jvm = spark.sparkContext._jvm
    fs, jd = hadoop_fs(spark, dest_dir)
    fs.mkdirs(jd)
    for p in paths:
        fsp, jp = hadoop_fs(spark, p)
        if not fsp.rename(jp, jvm.org.apache.hadoop.fs.Path(f"{dest_dir.rstrip('/')}/{jp.getName()}")):
            raise IOError(f"could not move {p} to {dest_dir}")
    return dest_dir


def _unused(spark: SparkSession, dest: str) -> str:
    """``dest``, or ``dest_2``, ``dest_3`` ... when an earlier run (same minute) used it."""
    fs, jp = hadoop_fs(spark, dest)
    n, cand = 1, dest
    while fs.exists(hadoop_fs(spark, cand)[1]):
        n += 1
        cand = f"{dest}_{n}"
    return cand


def apply_disposition(spark: SparkSession, plan: DataFrame, manifest: DataFrame, archive_dir: str,
                      compression: str | None = "gzip") -> DataFrame:
    """Carry out F4's plan: one archive or folder per destination. Returns the plan."""
    todo = (plan.where(F.col("action") != "stay").join(manifest.select("FILE_NAME", "path"), "FILE_NAME")
            .groupBy("action", "destination").agg(F.collect_list("path").alias("paths")).collect())
    for row in todo:
        dest = _unused(spark, f"{archive_dir.rstrip('/')}/{row['destination']}")
        if row["action"] == "move":
            move_files(spark, row["paths"], dest)
        else:
            archive_files(spark, row["paths"], dest, compression, remove_sources=True)
    return plan
