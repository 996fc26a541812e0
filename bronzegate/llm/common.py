"""What the corpus operators share: staged tables, size-checked broadcasts, word rules.

A *stage* is written as Parquet into the shared folder that ``spark.checkpoint.dir``
names and read back.  That cuts the lineage (a lost executor re-runs one stage,
not the whole operator), gives the next join two plain exchanges, which adaptive
execution can split when one key is hot, and lets Spark drop the shuffle files
of the stage at once, so the disk holds one stage's shuffle at a time.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzegate.session import hadoop_fs, shared_dir

#: A word is a run of characters other than these six ASCII white-space ones.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A side is broadcast only when it was counted and has at most this many rows.
BROADCAST_ROWS = 200_000

_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """``key`` set to ``value`` within the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


class Stages:
    """Named intermediate tables of one run of one operator."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.root = shared_dir(spark, operator)
        self._n = 0
        self._tables: list[tuple[str, str]] = []

    def save(self, df: DataFrame, name: str, compression: str | None = None, batch: int | None = None) -> DataFrame:
        """Write ``df`` and return the table as read back; ``batch`` is how many rows at a time go to Python."""
        self._n += 1
        path = f"{self.root}/{self._n:02d}-{name}"
        with setting(self.spark, _CLEANUP, "true"), setting(self.spark, _ROWS, str(batch or self.spark.conf.get(_ROWS))):
            df.write.parquet(path, compression=compression)
        self._tables.append((name, path))
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str, older: bool = False) -> None:
        """Delete the tables of these names (``older``: all but the newest of each) when nothing will read them again."""
        newest = {name: path for name, path in self._tables}
        gone = [(n, p) for n, p in self._tables if n in names and not (older and p == newest[n])]
        for _, path in gone:
            fs, jpath = hadoop_fs(self.spark, path)
            fs.delete(jpath, True)
        self._tables = [t for t in self._tables if t not in gone]

    def finish(self, df: DataFrame, name: str = "result") -> DataFrame:
        """Write the operator's result and delete the tables it was made of.

        The result is complete on shared storage by then, so a lost executor needs none of them.
        """
        made_of = [n for n, _ in self._tables]
        out = self.save(df, name)
        self.drop(*made_of)
        return out


def small(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows, else ``df`` unmarked.

    Beyond the limit the join is an ordinary shuffle join with the same result.
    ``rows`` saves the count where the caller has it.
    """
    return F.broadcast(df) if (df.count() if rows is None else rows) <= limit else df


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all else unchanged (``lower`` alone would also change É)."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
