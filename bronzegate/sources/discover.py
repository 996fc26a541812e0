"""S1 file discovery and F1/F2 manifest filters.

The manifest is a DataFrame with one row per raw file: its path, size and the
five name-derived metadata columns. File identity is a column; nothing loops
over files in Python.
"""

from __future__ import annotations

import datetime as _dt

from functools import reduce
from operator import and_
from typing import Callable, Iterable, Sequence, Union

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..session import hadoop_fs
from ..functions.columns import file_metadata_columns

ManifestFilter = Union[Column, Callable[[DataFrame], Column]]

LISTING_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()),
])


def list_files(spark: SparkSession, raw_dir: str, glob: str = S.DEFAULT_GLOB) -> DataFrame:
    """Non-recursive listing of ``raw_dir`` matching ``glob``: path, length, modificationTime.

    One glob call through the Hadoop FileSystem API (what Spark's own file
    index does on the driver). Unlike a file-source scan, this keeps zero-byte
    files, which must be reported as unreadable rather than silently skipped.
    Only regular files are listed.
    """
    fs, _ = hadoop_fs(spark, raw_dir)
    jvm = spark.sparkContext._jvm
    statuses = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{raw_dir.rstrip('/')}/{glob}")) or []
    rows = [(st.getPath().toString(), int(st.getLen()),
             _dt.datetime.fromtimestamp(st.getModificationTime() / 1000.0))
            for st in statuses if st.isFile()]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def manifest_from_names(names: DataFrame, name_col: str = "FILE_NAME") -> DataFrame:
    """Manifest columns for a frame of file names."""
    keep = [F.col(c) for c in names.columns if c != name_col and c not in S.FILE_METADATA_COLUMNS]
    return names.select(*file_metadata_columns(F.col(name_col)), *keep)


def name_errors() -> Column:
    """What a manifest row's file name fails to give, as one message (null if nothing)."""
    parts = F.array_compact(F.array(*[F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(c))
                                      for c in ("FILE_DATE", "INSTANCE", "PROVINCE")]))
    return F.when(F.size(parts) > 0, F.concat(F.lit("file name does not give "), F.array_join(parts, ", ")))


def detect_incoming(spark: SparkSession, raw_dir: str, glob: str = S.DEFAULT_GLOB,
                    filters: ManifestFilter | Sequence[ManifestFilter] | None = None) -> DataFrame:
    """S1 + P1 + F1: manifest of incoming files, optionally filtered.

    Columns: FILE_NAME, FILE_DATE, INSTANCE, PROVINCE, EXTRACT_TYPE, path, length, modificationTime.
    """
    listing = list_files(spark, raw_dir, glob)
    named = listing.select(F.element_at(F.split("path", "/"), -1).alias("FILE_NAME"), "path", "length", "modificationTime")
    return apply_filters(manifest_from_names(named), filters)


def apply_filters(manifest: DataFrame,
                  filters: ManifestFilter | Sequence[ManifestFilter] | None) -> DataFrame:
    """no filter keeps all; one predicate; or several predicates AND-ed.

    A predicate is a Column over the manifest columns or a function
    ``manifest -> Column`` (U1); it runs inside Spark, never as a Python UDF.
    """
    if filters is None:
        return manifest
    if isinstance(filters, Column) or callable(filters):
        filters = [filters]
    preds: Iterable[Column] = (f(manifest) if callable(f) and not isinstance(f, Column) else f
                               for f in filters)
    return manifest.where(reduce(and_, preds, F.lit(True)))


def split_extract_types(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(questions, scoring) manifests."""
    return (manifest.where(F.col("EXTRACT_TYPE") == S.QUESTIONS),
            manifest.where(F.col("EXTRACT_TYPE") == S.SCORING))


def order_manifest(manifest: DataFrame) -> DataFrame:
    """O1: FILE_DATE, INSTANCE, PROVINCE, FILE_NAME."""
    return manifest.orderBy("FILE_DATE", "INSTANCE", "PROVINCE", "FILE_NAME")
