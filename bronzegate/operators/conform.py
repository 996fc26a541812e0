"""Typed, lineage-stamped rows from raw string rows, in the fixed order.

Order matters (H5): the composite ID is built from the raw values (a missing
part reads ``nan``), the null report looks at the values before the fill, the
counts look at the values after it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.columns import (
    col,
    file_metadata_columns,
    fill_empty,
    float_failed,
    timestamp_failed,
    to_timestamp_ntz,
    unique_assessment_id,
)

BAD_PREFIX = "__bad__"
NULL_PREFIX = "__null__"


def conform(rows: DataFrame, extract_type: str, ingestion_ts: _dt.datetime | Column | None = None,
            pattern: str = S.DATE_PATTERN, with_metadata: bool = False) -> DataFrame:
    """Typed rows with lineage, plus per-row flag columns used by the file rollup.

    Output: declared columns (typed), undeclared columns (strings), the lineage
    columns, then ``__bad__<col>`` (value not convertible) and ``__null__<col>``
    (string missing before the fill) flags; ``data_columns``/``flag_columns``
    split them again. ``with_metadata``: the rows bring the columns that the file name gives (P1).
    """
    strings, floats, dates = (S.string_columns(extract_type), S.float_columns(extract_type),
                              S.date_columns(extract_type))
    declared = set(strings) | set(floats) | set(dates)
    # A raw column named like a lineage or declared column (letter case aside) gives way to it.
    taken = {c.lower() for c in declared} | {c.lower() for c in S.LINEAGE_COLUMNS}
    extras = [c for c in rows.columns if c not in declared and c.lower() not in taken]
    if ingestion_ts is None:
        ts = F.localtimestamp()
    elif isinstance(ingestion_ts, Column):
        ts = ingestion_ts
    else:
        ts = F.lit(ingestion_ts).cast(T.TimestampNTZType())
    meta = [F.col(c) for c in S.FILE_METADATA_COLUMNS] if with_metadata else file_metadata_columns(F.col("FILE_NAME"))
    raw = "__raw__"
    # Step 1: every conversion is computed once; the raw text of typed columns
    # is kept under a temporary name for the failure flags of step 2.
    staged = rows.select(
        *[col(c) for c in strings],
        # Plain cast here; the syntax guard sits in the failure flag (a flagged
        # value makes its file unreadable, so the typed value is never used).
        *[F.trim(col(c)).try_cast(T.FloatType()).alias(c) for c in floats],
        *[to_timestamp_ntz(col(c), pattern).alias(c) for c in dates],
        *[col(c).alias(raw + c) for c in floats + dates],
        *[col(c) for c in extras],
        F.col("FILE_NAME"), *meta[1:],
    ).withColumn(S.ID_COLUMN, unique_assessment_id())
    # Step 2: fill, lineage order, and flags read the converted values.
    out = (
        [fill_empty(col(c)).alias(c) for c in strings]
        + [col(c) for c in floats + dates]
        + [col(c) for c in extras]
        + [ts.alias("INGESTION_TIMESTAMP"), F.col("FILE_NAME"), F.col("FILE_DATE"), F.col("INSTANCE"),
           F.col("PROVINCE"), F.col("EXTRACT_TYPE"), F.col(S.ID_COLUMN)]
        + [float_failed(col(raw + c), col(c)).alias(BAD_PREFIX + c) for c in floats]
        + [timestamp_failed(col(raw + c), pattern, col(c)).alias(BAD_PREFIX + c) for c in dates]
        + [col(c).isNull().alias(NULL_PREFIX + c) for c in strings]
    )
    return staged.select(*out)


def flag_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(BAD_PREFIX) or c.startswith(NULL_PREFIX)]


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not (c.startswith(BAD_PREFIX) or c.startswith(NULL_PREFIX))]


def without_flags(df: DataFrame) -> DataFrame:
    return df.select(*[col(c) for c in data_columns(df)])
