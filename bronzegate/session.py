"""Session helpers: building a session for tests/bench and locating shared storage.

Nothing here is specific to one query. ``shared_dir`` is the only place the
library writes scratch data; it always derives from ``spark.checkpoint.dir`` so
that on a cluster every executor sees the same folder.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that every session created by this package uses. AQE re-plans joins
# and coalesces shuffle partitions at runtime; skew-join splitting handles a hot
# key on the large side of an anti/semi join.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # A fused stage whose generated method exceeds the JIT's 8000-byte limit
    # runs interpreted; fall back to per-expression compiled code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Each PySpark API call would otherwise capture its Python call site and
    # make extra JVM round trips (~1 ms per call while building a plan).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "bronzegate") -> SparkSession:
    """Create (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("BRONZEGATE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may leave it unset (unit tests, a laptop): then the
    session's own checkpoint folder is used, or a fresh temporary one is set.
    On a cluster that folder would not be shared, so an unset name is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="bronzegate-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder path of the shared checkpoint folder (not created)."""
    return f"{checkpoint_root(spark)}/bronzegate/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder; survives executor loss."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


#: How rows that are read back soon, and whole, are written: small, and without the bounds of values.
SCRATCH = {"compression": "zstd", "parquet.column.statistics.enabled": "false"}


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a checkpoint that drops its shuffle files at once (those of a
    checkpoint stay until the driver's garbage is collected)."""
    path = shared_dir(df.sparkSession, name)
    with dropped_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int, known_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when its row count is proven to be at most ``max_rows``.

    ``known_rows`` lets a caller pass a bound it already has (for example the
    number of files in a listing); otherwise the rows are counted. Beyond the
    bound the frame is returned unchanged and the join planner (with AQE)
    picks a shuffle join.
    """
    n = known_rows if known_rows is not None else df.count()
    return F.broadcast(df) if n <= max_rows else df


def max_partition_bytes(spark: SparkSession) -> int:
    """``spark.sql.files.maxPartitionBytes`` in bytes (the size of one file split)."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes", "128m")
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


#: Splits are read several to a task up to about this size.
TASK_BYTES = 32 << 20


def together(files: DataFrame) -> DataFrame:
    """Rows of a file scan with many small splits to a task: the splits stay, each is still read apart and in order.

    Splits of ``TASK_BYTES`` / 4 or more keep a task each.
    """
    spark = files.sparkSession
    size = max_partition_bytes(spark)
    if size * 4 >= TASK_BYTES:
        return files
    most = max(math.ceil(files.rdd.getNumPartitions() * size / TASK_BYTES), 4 * spark.sparkContext.defaultParallelism)
    return files.coalesce(most)


@contextmanager
def dropped_shuffles(spark: SparkSession):
    """While active, a write drops its shuffle files when it ends, so the disk holds those of one at a time."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def compiled_methods(spark: SparkSession):
    """While active, wide projections run as small methods: the JIT leaves a method above 8000 bytes interpreted."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def delete_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``shared_dir`` that nothing reads any more."""
    fs, at = hadoop_fs(spark, path)
    fs.delete(at, True)


def hadoop_fs(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path for ``path`` (works for local and shared stores)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath
