"""Extract layouts, tokens, domains and the ingestion-log schema.

Everything in the block below must equal the values the landing contract
expects (column names, types, date format, NA tokens, domains, default glob).
They are stated plainly, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the landed-extract contract exactly)
# ---------------------------------------------------------------------------

QUESTIONS = "Questions"
SCORING = "Scoring"
EXTRACT_TYPES = (QUESTIONS, SCORING)

DEFAULT_GLOB = "*MDSAssessment*.csv"
SEPARATOR = "|"

# Date/time text format of every declared date column ('%Y-%m-%d %H:%M:%S').
# The Spark pattern uses single letters so unpadded parts are accepted, as the
# strptime-style parser does; fractions of a second and out-of-range parts fail.
DATE_PATTERN = "yyyy-M-d H:m:s"

QUESTIONS_STRING_COLUMNS = [
    "Facility ID", "Resident ID", "Unit", "Assessment ID", "Assessment Type",
    "question_key", "item_value", "Answer",
]
QUESTIONS_FLOAT_COLUMNS: list[str] = []
QUESTIONS_DATE_COLUMNS = ["ARD", "Answer_Date"]

SCORING_STRING_COLUMNS = [
    "Facility ID", "Resident ID", "Unit", "Assessment ID", "RAI-MDS Status", "Rug Group",
]
SCORING_FLOAT_COLUMNS = [
    "CMI", "CPS", "DRS", "COM", "PAIN", "CHESS", "ISE", "ADL_SHORT", "ADL_LONG",
    "ADL_HIER", "ABS", "PSI", "PURS", "FRS",
]
SCORING_DATE_COLUMNS = [
    "ARD", "Assessment Locked Date", "Date Assessment Created", "Date Assessment Revised",
]

# Text values read as missing by the strict parser (quoted or not).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Accepted values of the file-name metadata columns.
DOMAINS = {
    "INSTANCE": ["EXT", "REV"],
    "PROVINCE": ["Ontario", "Alberta"],
    "EXTRACT_TYPE": ["Scoring", "Questions"],
}

# Text used for a missing part of the composite assessment ID.
MISSING_ID_PART = "nan"

# Lineage columns, in the order they are appended to every landed row.
LINEAGE_COLUMNS = [
    "INGESTION_TIMESTAMP", "FILE_NAME", "FILE_DATE", "INSTANCE", "PROVINCE",
    "EXTRACT_TYPE", "UNIQUE_ASSESSMENT_ID",
]
FILE_METADATA_COLUMNS = ["FILE_NAME", "FILE_DATE", "INSTANCE", "PROVINCE", "EXTRACT_TYPE"]

ID_COLUMN = "UNIQUE_ASSESSMENT_ID"
RESIDENT_COLUMN = "Resident ID"
FACILITY_COLUMN = "Facility ID"
ASSESSMENT_COLUMN = "Assessment ID"

# Archive folders/bundles for clean and for reviewed files, and the codec.
DEFAULT_ARCHIVE_BEHAVIOUR = ("tarball", "ingested")
DEFAULT_ARCHIVE_ERR_BEHAVIOUR = ("move", "ingested-review")
DEFAULT_ARCHIVE_CODEC = "gzip"

# Messages of the per-pair ID check (the ingestion log keeps them verbatim).
MSG_IDS_UNEQUAL = (
    "Unique Assessment ID sets not equal between {left} and {right}. "
    "Relationship: ColumnDomainRelationship.{rel}."
)
MSG_LEFT_LABEL = "left dataframe (questions file {name})"
MSG_RIGHT_LABEL = "right dataframe (scoring file {name})"
MSG_EMPTY_RIGHT = "Column value check is invalid. Right dataframe is empty [{left} has values and {right} doesn't]"
MSG_EMPTY_LEFT = "Column value check is invalid. Left dataframe is empty [{right} has values and {left} doesn't]"
MSG_EMPTY_BOTH = "Column value check is invalid. Both dataframes are empty [{left} and {right} are empty]"

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------


def string_columns(extract_type: str) -> list[str]:
    return QUESTIONS_STRING_COLUMNS if extract_type == QUESTIONS else SCORING_STRING_COLUMNS


def float_columns(extract_type: str) -> list[str]:
    return QUESTIONS_FLOAT_COLUMNS if extract_type == QUESTIONS else SCORING_FLOAT_COLUMNS


def date_columns(extract_type: str) -> list[str]:
    return QUESTIONS_DATE_COLUMNS if extract_type == QUESTIONS else SCORING_DATE_COLUMNS


def declared_columns(extract_type: str) -> list[str]:
    """Declared data columns in declaration order (strings, floats, then dates)."""
    return string_columns(extract_type) + float_columns(extract_type) + date_columns(extract_type)


def data_schema(extract_type: str) -> T.StructType:
    """Typed schema of the declared data columns."""
    fields = [T.StructField(c, T.StringType()) for c in string_columns(extract_type)]
    fields += [T.StructField(c, T.FloatType()) for c in float_columns(extract_type)]
    fields += [T.StructField(c, T.TimestampNTZType()) for c in date_columns(extract_type)]
    return T.StructType(fields)


def bronze_schema(extract_type: str) -> T.StructType:
    """Schema of a bronze table: data columns then lineage columns."""
    lineage = [
        T.StructField("INGESTION_TIMESTAMP", T.TimestampNTZType()),
        T.StructField("FILE_NAME", T.StringType()),
        T.StructField("FILE_DATE", T.DateType()),
        T.StructField("INSTANCE", T.StringType()),
        T.StructField("PROVINCE", T.StringType()),
        T.StructField("EXTRACT_TYPE", T.StringType()),
        T.StructField("UNIQUE_ASSESSMENT_ID", T.StringType()),
    ]
    return T.StructType(list(data_schema(extract_type).fields) + lineage)


MANIFEST_SCHEMA = T.StructType([
    T.StructField("FILE_NAME", T.StringType()),
    T.StructField("FILE_DATE", T.DateType()),
    T.StructField("INSTANCE", T.StringType()),
    T.StructField("PROVINCE", T.StringType()),
    T.StructField("EXTRACT_TYPE", T.StringType()),
])

INGESTION_LOG_SCHEMA = T.StructType([
    T.StructField("FILE_NAME", T.StringType()),
    T.StructField("FILE_DATE", T.DateType()),
    T.StructField("INSTANCE", T.StringType()),
    T.StructField("PROVINCE", T.StringType()),
    T.StructField("EXTRACT_TYPE", T.StringType()),
    T.StructField("N_ROWS", T.LongType()),
    T.StructField("N_RESIDENTS", T.LongType()),
    T.StructField("N_FACILITIES", T.LongType()),
    T.StructField("N_UNIQUE_ASSESSMENTS", T.LongType()),
    T.StructField("READ_ERRORS", T.ArrayType(T.StringType())),
    T.StructField("READ_SUCCESS", T.BooleanType()),
    T.StructField("INGEST_ERRORS", T.ArrayType(T.StringType())),
    T.StructField("INGEST_SUCCESS", T.BooleanType()),
    T.StructField("PROCESSED_TIMESTAMP", T.TimestampNTZType()),
])
INGESTION_LOG_COLUMNS = [f.name for f in INGESTION_LOG_SCHEMA.fields]
