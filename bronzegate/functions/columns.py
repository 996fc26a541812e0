"""Scalar column expressions used by the landing job.

Every function returns a ``Column`` built from built-in functions only, so the
expressions stay inside whole-stage code generation.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


def col(name: str) -> Column:
    """Column by name, safe for names with spaces, dots or dashes."""
    return F.col(f"`{name}`")


# --- P1: file-name metadata ------------------------------------------------

def name_tokens(file_name: Column) -> Column:
    """Name without its 4-character suffix, split on '_'."""
    stem = file_name.substr(F.lit(1), F.length(file_name) - 4)
    return F.split(stem, "_", -1)


def parse_date_token(token: Column) -> Column:
    """A date written as yyyy-MM-dd or yyyyMMdd; anything else is null."""
    iso = F.when(token.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), token.try_cast(T.DateType()))
    return F.coalesce(iso, F.try_to_date(token, "yyyyMMdd"))


def file_metadata_columns(file_name: Column) -> list[Column]:
    """FILE_NAME, FILE_DATE, INSTANCE, PROVINCE, EXTRACT_TYPE parsed from a file name.

    Token 0 is the instance, token 2 the province, the last token the date;
    a name containing ``Scoring`` is a Scoring extract, any other a Questions extract.
    """
    t = name_tokens(file_name)
    return [
        file_name.alias("FILE_NAME"),
        parse_date_token(F.element_at(t, -1)).alias("FILE_DATE"),
        F.get(t, 0).alias("INSTANCE"),
        F.get(t, 2).alias("PROVINCE"),
        F.when(file_name.contains(S.SCORING), F.lit(S.SCORING)).otherwise(F.lit(S.QUESTIONS))
         .alias("EXTRACT_TYPE"),
    ]


def with_file_metadata(df: DataFrame, name_col: str = "FILE_NAME") -> DataFrame:
    """Replace ``name_col`` by the five manifest columns."""
    others = [col(c) for c in df.columns if c not in (name_col, *S.FILE_METADATA_COLUMNS)]
    return df.select(*file_metadata_columns(col(name_col)), *others)


def pair_key(file_name: Column) -> Column:
    """Key shared by the two files of a delivery: the name without ``Scoring``."""
    return F.replace(file_name, F.lit(S.SCORING), F.lit(""))


# --- P3: composite assessment ID ------------------------------------------

def unique_assessment_id(instance: Column | None = None, province: Column | None = None,
                         facility: Column | None = None, resident: Column | None = None,
                         assessment: Column | None = None, file_date: Column | None = None) -> Column:
    """INSTANCE|PROVINCE|Facility ID|Resident ID|Assessment ID|yyyy-MM-dd.

    Built before missing strings are filled, so a missing part reads ``nan``.
    A missing FILE_DATE leaves the whole ID missing.
    """
    parts = [instance if instance is not None else col("INSTANCE"),
             province if province is not None else col("PROVINCE"),
             facility if facility is not None else col(S.FACILITY_COLUMN),
             resident if resident is not None else col(S.RESIDENT_COLUMN),
             assessment if assessment is not None else col(S.ASSESSMENT_COLUMN)]
    fd = file_date if file_date is not None else col("FILE_DATE")
    texts = [F.coalesce(p.cast("string"), F.lit(S.MISSING_ID_PART)) for p in parts]
    # A DATE cast to text is ISO yyyy-MM-dd.
    return F.when(fd.isNotNull(), F.concat_ws("|", *texts, fd.cast("date").cast("string")))


# --- P4 / P5: typed values with failure flags -------------------------------

# Spark's text-to-float cast (Java's parser) also takes a d/f suffix and hex
# floats, which are not numbers in the extract contract; inf/nan words are.
_JAVA_ONLY = r"[dDfFxXpP]"
_FLOAT_WORDS = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan", "+nan", "-nan"]


def _float_text_ok(t: Column) -> Column:
    return ~t.rlike(_JAVA_ONLY) | F.lower(t).isin(_FLOAT_WORDS)


def to_float(c: Column) -> Column:
    """Text to FLOAT; text that is not a plain decimal/scientific number becomes null."""
    t = F.trim(c)
    return F.when(_float_text_ok(t), t.try_cast(T.FloatType()))


def float_failed(c: Column, parsed: Column | None = None) -> Column:
    """True when a present, non-blank value is not a number (blank reads as missing).

    With ``parsed`` given (the plain ``try_cast`` of the trimmed text), the
    syntax guard is evaluated here only, which keeps generated code small.
    """
    t = F.trim(c)
    if parsed is None:
        return c.isNotNull() & (t != F.lit("")) & to_float(c).isNull()
    return c.isNotNull() & (t != F.lit("")) & (parsed.isNull() | ~_float_text_ok(t))


_DATE_PARTS = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"


def to_timestamp_ntz(c: Column, pattern: str = S.DATE_PATTERN) -> Column:
    """Text in the declared date format to TIMESTAMP_NTZ (microseconds); empty -> null.

    One regex checks the exact shape (4-digit year, 1-2 digit parts, no
    fraction); the value is then a time-zone-free ``try_cast`` to
    TIMESTAMP_NTZ, which rejects out-of-range parts (month 13, Feb 30, 24:00).
    Other patterns use the parser, which reads in the session time zone.
    """
    if pattern != S.DATE_PATTERN:
        return F.try_to_timestamp(c, F.lit(pattern)).cast(T.TimestampNTZType())
    return F.when(c.rlike(_DATE_PARTS), c.try_cast(T.TimestampNTZType()))


def timestamp_failed(c: Column, pattern: str = S.DATE_PATTERN, parsed: Column | None = None) -> Column:
    """True when a present, non-empty text is not a timestamp in the declared format."""
    parsed = parsed if parsed is not None else to_timestamp_ntz(c, pattern)
    return c.isNotNull() & (c != F.lit("")) & parsed.isNull()


def timestamps_to_micros(df: DataFrame) -> DataFrame:
    """Every timestamp column as TIMESTAMP_NTZ (Spark keeps microseconds natively)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(col(f.name).cast(T.TimestampNTZType()).alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)


# --- P7 / P8: missing values ------------------------------------------------

def na_to_null(c: Column, tokens: Sequence[str] = tuple(S.NA_TOKENS)) -> Column:
    """Text equal to one of the NA tokens becomes null."""
    return F.when(~c.isin(list(tokens)) | c.isNull(), c)


def fill_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


# --- P10: accepted values -----------------------------------------------------

def accepted(c: Column, domain: Sequence[str]) -> Column:
    """Value if inside ``domain``, else null."""
    return F.when(c.isin(list(domain)), c)


# --- P11: list column non-empty ---------------------------------------------

def nonempty(c: Column) -> Column:
    return F.size(F.coalesce(c, F.array().cast(T.ArrayType(T.StringType())))) > 0


# --- P12: tolerant line split -----------------------------------------------

def clean_split(line: Column, sep: str = S.SEPARATOR) -> Column:
    """Trim surrounding whitespace, split on the raw separator (no quote rules),
    and strip every leading/trailing double quote from each field."""
    import re

    trimmed = F.regexp_replace(line, r"^\s+|\s+$", "")
    parts = F.split(trimmed, re.escape(sep), -1)
    return F.transform(parts, lambda x: F.regexp_replace(x, r'^"+|"+$', ""))


# --- P13 ----------------------------------------------------------------------

def as_date(c: Column) -> Column:
    return F.to_date(c)
