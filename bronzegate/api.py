"""The original package's entry points under their familiar names, on Spark.

Each name maps onto the Spark implementation; signatures take a
``SparkSession`` where the work needs one, and return DataFrames / Columns
instead of pandas objects.
"""

from __future__ import annotations

import datetime as _dt
import os
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from . import schemas as S
from .functions.columns import clean_split, col, nonempty, timestamps_to_micros
from .functions.columns import unique_assessment_id as _uid
from .operators.errors import ColCheckOnEmptyDF, ColCheckOnMissingCol, UncoveredAssessmentError  # noqa: F401
from .operators.models import (  # noqa: F401
    BOTH,
    COL_MISSING,
    DF_EMPTY,
    EQUAL,
    LEFT_NOT_RIGHT,
    RIGHT_NOT_LEFT,
    ColumnDomainRelationship,
    ColumnDomainResult,
)
from .operators.quality import check_column_value_sets  # noqa: F401
from .plans.landing import LandingResult, land
from .sources import archive as _archive
from .sources import bronze as _bronze
from .sources.discover import detect_incoming, split_extract_types
from .sources.scan import line_stats, scan_tolerant

CompressAlg = {"GZIP": "gzip", "BZIP2": "bz2", "LZMA": "xz"}


def unique_assessment_id(df: DataFrame) -> Column:
    """Composite ID column for a frame with the lineage and key columns."""
    return _uid()


def enforce_datetime64us(df: DataFrame) -> DataFrame:
    return timestamps_to_micros(df)


def list_col_nonempty(df: DataFrame, list_col: str) -> Column:
    return nonempty(col(list_col))


def clean_parse_line(line: Column, sep: str = S.SEPARATOR) -> Column:
    return clean_split(line, sep)


def manual_parse(spark: SparkSession, bad_file: str, sep: str = S.SEPARATOR) -> DataFrame:
    """Tolerant parse of one file: first line is the header, no quote rules."""
    if line_stats(spark, [bad_file], sep).isEmpty():
        raise ValueError(f"{bad_file} is empty")
    return scan_tolerant(spark, bad_file, sep)


def divide_extract_types(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_extract_types(manifest)


def tarball_files(spark: SparkSession, src_files: Sequence[str], dest_dir: str, dest_fname: str,
                  cmprsn: str | None = "gzip", retain_structure: bool = False) -> str:
    """Verified archive of the files at ``dest_dir/dest_fname``; sources are removed afterwards."""
    return _archive.archive_files(spark, src_files, f"{dest_dir.rstrip('/')}/{dest_fname}", cmprsn,
                                  retain_structure=retain_structure, remove_sources=True)


def move_files(spark: SparkSession, src_files: Sequence[str], dest_dir: str) -> str:
    return _archive.move_files(spark, src_files, dest_dir)


def get_or_create_delta(spark: SparkSession, path: str, for_data: DataFrame | None = None, schema=None,
                        name: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    return _bronze.get_or_create_table(spark, path, for_data, schema, name, partition_by)


def get_change_data(spark: SparkSession, path: str, from_version: int = 0,
                    to_version: int | None = None) -> DataFrame:
    """Rows landed by batches ``from_version..to_version`` of the table at ``path``."""
    table = _bronze.read_table(spark, path)
    if table is None:
        raise FileNotFoundError(path)
    return _bronze.change_feed(table, from_version, to_version)


def raw_to_bronze(spark: SparkSession, data_dir: str | None = None, **kwargs) -> LandingResult:
    """Land ``<data_dir>/0-raw`` into ``<data_dir>/1-bronze`` (``DATA_DIR`` when not given)."""
    data_dir = data_dir or os.environ.get("DATA_DIR")
    if not data_dir:
        raise ValueError("data_dir (or the DATA_DIR environment variable) is required")
    kwargs.setdefault("run_ts", _dt.datetime.now().replace(microsecond=0))
    return land(spark, f"{data_dir.rstrip('/')}/0-raw", f"{data_dir.rstrip('/')}/1-bronze", **kwargs)


__all__ = [
    "check_column_value_sets", "ColumnDomainResult", "ColumnDomainRelationship", "EQUAL", "LEFT_NOT_RIGHT",
    "RIGHT_NOT_LEFT", "BOTH", "DF_EMPTY", "COL_MISSING", "ColCheckOnEmptyDF", "ColCheckOnMissingCol",
    "UncoveredAssessmentError", "unique_assessment_id", "enforce_datetime64us", "list_col_nonempty",
    "clean_parse_line", "manual_parse", "detect_incoming", "divide_extract_types", "tarball_files",
    "move_files", "get_or_create_delta", "get_change_data", "raw_to_bronze", "CompressAlg",
]
