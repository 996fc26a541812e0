"""Strict and tolerant scans of pipe-delimited extracts, routed per file.

Plan (a constant number of text scans, whatever the number of files, their headers and sizes):

1. ``file_stats``: one pass over all lines. Per file: header line, distinct row widths, lines
   that leave a quote open, blank lines -- one small row per file.
2. Files in which a quote stays open over a line end also get the quote state of each line
   (``quotes.store_lines``), which tells multi-line records and quotes that never close.
3. Route per file:
     unreadable   no bytes at all
     tolerant     a record with more fields than the header, or an unclosed quote
     strict       everything else
4. One pass binds fields BY NAME at row level: the routing table holds, per file, the position of
   every wanted column, so files with different headers need no scan of their own. Strict
   records are taken apart by the quote rules; tolerant lines are split on the raw separator.

File names do not become literals of a plan: the folders are scanned and rows are joined with
the routing table (broadcast while its measured size is bounded). Only where other files make up more than
``OTHERS`` of what is asked for, and names are few, the scan is told the names. What reaches the driver
is the distinct folders, up to ``MAX_NAMED_FILES`` file names, the names of undeclared columns (they are part of the schema) and two
counts per extract type.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import clean_split, file_metadata_columns, na_to_null
from ..session import TASK_BYTES, broadcast_if_small, cut_lineage, delete_dir, hadoop_fs, shared_dir
from . import quotes as Q

ROUTE_UNREADABLE = "unreadable"
ROUTE_TOLERANT = "tolerant"
ROUTE_STRICT = "strict"

#: The routing table is broadcast up to this many bytes (rows times measured width).
BROADCAST_BYTES = 64 << 20

#: Where the folders hold more than this share of other bytes, up to ``MAX_NAMED_FILES`` files are named to the scan, so it opens no other.
OTHERS = 0.25
#: Splits (a row of about 100 bytes each) whose quote states are broadcast to their lines.
MAX_BROADCAST_SPLITS = 250_000
MAX_NAMED_FILES = 4096

_NO_ERRORS = "array<string>"


def _folders(manifest: DataFrame) -> list[str]:
    """The folders that hold the manifest's files."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return [r[0] for r in manifest.select(folder.alias("folder")).distinct().collect()]


def _whole(high: str, low: str) -> Column:
    """The sum of 64-bit numbers from the sums of their halves, exact."""
    return (F.col(high).cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.col(low).cast("decimal(20,0)")).cast("decimal(38,0)")


def file_stats(lines: DataFrame) -> DataFrame:
    """Per file, from lines with their effects: header and its place, row widths, blank and quote-opening lines.

    The header is the first line that is not blank. ``widths`` holds the distinct field counts of the
    lines that are records of their own. ``content_hash`` is the number of lines and the sum of their
    hashes: equal for equal content, whatever the splits.
    """
    first = F.min(F.when((F.col("blk") == 0) & ~F.col("blank"), F.struct("mid", "value")))
    return lines.groupBy("FILE_NAME").agg(
        first.alias("first"), F.count(F.lit(1)).alias("n_lines"), F.count_if("blank").alias("n_blank"),
        F.count_if("out_in").alias("n_open"),
        F.collect_set(F.when(~F.col("blank") & ~F.col("out_in"), F.col("out_seps") + 1)).alias("widths"),
        # Summed in halves, as whole numbers: a sum of decimals costs several times as much a line.
        F.sum(F.shiftright(F.xxhash64("value"), 32)).alias("high"),
        F.sum(F.xxhash64("value").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
    ).select("FILE_NAME", F.concat_ws(":", F.col("n_lines"), _whole("high", "low")).alias("content_hash"), F.regexp_replace("first.value", "^﻿|\r$", "").alias("header"),
             F.col("first.mid").alias("header_mid"), "n_lines", "n_blank", "n_open", "widths")


def line_stats(spark: SparkSession, paths: list[str], sep: str = S.SEPARATOR) -> DataFrame:
    """``file_stats`` of some files or folders."""
    return file_stats(Q.with_effects(Q.read_lines(spark, list(paths)), sep))


def header_names(header: Column, tolerant: Column, sep: str = S.SEPARATOR) -> Column:
    """Column names of a header line: by the quote rules, a repeated name gets .1, .2 ...; tolerant
    headers are trimmed, split and stripped of outer quotes."""
    def named(names: Column) -> Column:
        return F.transform(names, lambda x, i: Q._let(F.size(F.filter(F.slice(names, F.lit(1), i), lambda y: y == x)),
                                                      lambda n: F.when(n == 0, x).otherwise(F.concat(x, F.lit("."), n.cast("string")))))

    return F.when(tolerant, clean_split(header, sep)).otherwise(Q._let(Q.fields(header, sep), named))


def route_files(manifest: DataFrame, stats: DataFrame, quoted: DataFrame | None = None, sep: str = S.SEPARATOR) -> DataFrame:
    """Per file: route, the read errors a fallback records, and the names of its header.

    ``quoted`` (FILE_NAME, unclosed, widest) describes the files with open lines.
    """
    j = manifest.select("FILE_NAME", "EXTRACT_TYPE").join(stats, "FILE_NAME", "left")
    if quoted is None:
        j = j.withColumns({"unclosed": F.lit(False), "widest": F.lit(None).cast("int")})
    else:
        j = j.join(quoted, "FILE_NAME", "left")
    # In a file with open lines only whole records count, else every line is one.
    widest = F.when(F.col("n_open") > 0, F.col("widest")).otherwise(F.array_max("widths"))
    j = j.withColumn("wide", F.size(Q.fields(F.col("header"), sep)))
    wide = F.col("wide")
    unclosed = F.coalesce("unclosed", F.lit(False))
    long_row = F.coalesce(widest > wide, F.lit(False))
    route = (F.when(F.col("n_lines").isNull(), ROUTE_UNREADABLE)
             .when(unclosed | long_row, ROUTE_TOLERANT).otherwise(ROUTE_STRICT))
    err = (F.when(F.col("n_lines").isNull(), F.lit("No columns to parse from file"))
           .when(unclosed, F.lit("Error tokenizing data. C error: EOF inside string"))
           .when(long_row, F.format_string("Error tokenizing data. C error: Expected %d fields, saw %d", wide, widest)))
    out = j.select("FILE_NAME", "EXTRACT_TYPE", "header", "header_mid", "n_open", "content_hash", route.alias("route"),
                   F.coalesce(F.array_compact(F.array(err)), F.array().cast(_NO_ERRORS)).alias("read_errors"))
    return out.withColumn("names", F.when(F.col("header").isNotNull(), header_names(F.col("header"), F.col("route") == ROUTE_TOLERANT, sep)))


def _position(names: Column, route: Column, target: Column) -> Column:
    """Index of a name (null if absent): its first place, in a tolerant header its last."""
    first = F.array_position(names, target)
    last = F.size(names) + 1 - F.array_position(F.reverse(names), target)
    return F.when(first > 0, F.when(route == ROUTE_TOLERANT, last).otherwise(first) - 1).cast("int")


def _missing(names: Column, declared: list[str]) -> Column:
    gone = F.array_except(F.array(*[F.lit(c) for c in declared]), F.coalesce(names, F.array().cast(_NO_ERRORS)))
    text = F.concat(F.lit("missing declared column(s) ["), F.array_join(F.transform(gone, lambda c: F.concat(F.lit("'"), c, F.lit("'"))), ", "), F.lit("]"))
    return F.when(F.size(gone) > 0, text)


@dataclass
class ScanResult:
    """Raw string rows of one extract type plus per-file read status."""

    rows: DataFrame | None          # FILE_NAME + declared and undeclared columns (strings)
    status: DataFrame               # FILE_NAME, route, read_errors, readable
    stored: DataFrame | None = None  # ``rows`` from the lines in ``folder``, for as long as it stays
    folder: str | None = None       # the lines of files with open quotes; the caller deletes it


def _size(manifest: DataFrame) -> int | None:
    """Bytes of the manifest's files, where their lengths are known."""
    if "length" not in manifest.columns:
        return None
    return manifest.agg(F.sum("length")).first()[0]


def _others(spark: SparkSession, folders: list[str], glob: str | None, asked: int | None) -> bool:
    """Whether reading past the folders' other files costs more than ``OTHERS`` of reading those asked for."""
    held = 0
    for folder in folders if asked is not None else []:
        fs, at = hadoop_fs(spark, f"{folder}/{glob or '*'}")
        held += sum(st.getLen() for st in fs.globStatus(at) or [] if st.isFile())
    return asked is not None and held - asked > OTHERS * asked


def _groups(spark: SparkSession, asked: int | None) -> int | None:
    """How many groups the lines are dealt to where more than the shuffle's own are needed to keep one near ``TASK_BYTES``."""
    n = math.ceil((asked or 0) / TASK_BYTES)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def _quoted_files(effects: DataFrame, stats: DataFrame, parts: int | None = None) -> DataFrame:
    """(FILE_NAME, unclosed, widest) of the files with open lines."""
    return _widest(*Q.states(effects.join(stats.where("n_open > 0").select("FILE_NAME"), "FILE_NAME"), parts))


def _widest(placed: DataFrame, ends: DataFrame) -> DataFrame:
    """(FILE_NAME, unclosed, widest) from placed lines."""
    counted = placed.where(~((F.col("state") == 0) & F.col("blank")))
    alone = (F.col("state") == 0) & ~F.col("ends")  # a record of one line
    widths = counted.where(~alone).groupBy("FILE_NAME", "rec_blk", "rec_mid").agg((F.sum("seps") + 1).alias("width")).select("FILE_NAME", "width")
    widths = widths.unionByName(counted.where(alone).groupBy("FILE_NAME").agg((F.max("seps") + 1).alias("width")))
    widest = widths.groupBy("FILE_NAME").agg(F.max("width").cast("int").alias("widest"))
    return ends.join(widest, "FILE_NAME", "left")


def _sized_broadcast(routing: DataFrame, n_files: int, n_columns: int) -> DataFrame:
    """One row a file: a name, a place and a position per column."""
    return F.broadcast(routing) if n_files * (200 + 4 * n_columns) <= BROADCAST_BYTES else routing


def scan_all(spark: SparkSession, manifest: DataFrame, sep: str = S.SEPARATOR, keep_undeclared: bool = True,
             skip_blank: bool = False, source_glob: str | None = None, n_files: int | None = None,
             with_metadata: bool = False, keep_lines: bool = False) -> dict[str, ScanResult]:
    """S4 for every extract type at once.

    ``skip_blank=True`` drops the rows that blank lines yield in a tolerant parse (the strict scan
    always skips blank lines). ``source_glob`` is a folder glob that covers the manifest; other
    files in it are read past, not parsed. Undeclared columns are kept under their first
    spelling; one that differs from a declared or lineage column in letter case only is dropped.
    ``with_metadata`` adds what the file names give (P1), worked out once a file, after FILE_NAME.
    The lines of files with open quotes are placed once and stored; ``keep_lines`` leaves them for ``ScanResult.stored``.
    """
    n_files = manifest.count() if n_files is None else n_files
    if not n_files:
        empty = spark.createDataFrame([], "FILE_NAME string, route string, read_errors array<string>, readable boolean, content_hash string")
        return {et: ScanResult(None, empty) for et in S.EXTRACT_TYPES}
    folder, _, glob = source_glob.rpartition("/") if source_glob else ("", "", None)
    sources = [folder] if source_glob else _folders(manifest)
    # The extract type is in the file name, so the scan of one type opens no file of the other. Where others
    # are many, the names asked for are compared with the listing, before a file is opened.
    kind = {S.SCORING: lambda n: n.contains(S.SCORING), S.QUESTIONS: lambda n: ~n.contains(S.SCORING)}
    asked = _size(manifest)
    if n_files <= MAX_NAMED_FILES and _others(spark, sources, glob, asked):
        by_kind = {et: [r[0] for r in manifest.where(of(F.col("FILE_NAME"))).select("FILE_NAME").collect()] for et, of in kind.items()}
        kind = {et: lambda n, some=some: n.isin(some) for et, some in by_kind.items()}
    parts = _groups(spark, asked)
    text = {et: Q.read_lines(spark, sources, glob, kind[et]) for et in S.EXTRACT_TYPES}
    # Inner joins with distinct names: a semi join would be moved to below ``together`` and set up once a split.
    names = _sized_broadcast(manifest.select("FILE_NAME").distinct(), n_files, 0)
    effects = {et: Q.with_effects(t.join(names, "FILE_NAME"), sep) for et, t in text.items()}
    # Per-file tables are written once and read back: what follows plans over a few rows, not over the scan again.
    stats = reduce(DataFrame.unionByName, [file_stats(e) for e in effects.values()]).cache()
    is_scoring = F.col("FILE_NAME").contains(S.SCORING)
    opened = [r[0] for r in stats.where("n_open > 0").select(F.when(is_scoring, S.SCORING).otherwise(S.QUESTIONS)).distinct().collect()]
    folders = {et: shared_dir(spark, "lines") for et in opened}
    with_open = _sized_broadcast(stats.where("n_open > 0").select("FILE_NAME"), n_files, 0)
    lines = {et: Q.store_lines(effects[et].join(with_open, "FILE_NAME"), folders[et], parts) for et in opened}
    # One row a split, worked out once: the lines meet it where they are and are not dealt again.
    splits = {et: cut_lineage(Q.split_states(lines[et])) for et in opened}
    splits = {et: broadcast_if_small(s, MAX_BROADCAST_SPLITS) for et, s in splits.items()}
    quoted = reduce(DataFrame.unionByName, [_widest(*Q.placed(lines[et], splits[et])) for et in opened]) if opened else None
    routed = route_files(manifest, stats, quoted, sep)
    declared = F.create_map(*[x for et in S.EXTRACT_TYPES for x in (F.lit(et), F.array(*[F.lit(c) for c in S.declared_columns(et)]))])
    missing = F.coalesce(*[F.when(F.col("EXTRACT_TYPE") == et, _missing(F.col("names"), S.declared_columns(et))) for et in S.EXTRACT_TYPES])
    routed = routed.withColumn("missing", missing).withColumn(
        "readable", (F.col("route") != ROUTE_UNREADABLE) & F.col("missing").isNull())
    routed = cut_lineage(routed)
    stats.unpersist()
    for at in () if keep_lines else folders.values():
        delete_dir(spark, at)
    # Schema facts: undeclared names per type, in order of their first place.
    own = F.array(*[F.lit(c.lower()) for c in S.LINEAGE_COLUMNS])
    lower = lambda c: F.lower(c)
    known = F.array_union(F.transform(F.element_at(declared, F.col("EXTRACT_TYPE")), lower), own)
    found = routed.where("readable").select("EXTRACT_TYPE", known.alias("known"), F.posexplode("names").alias("at", "name"))
    extra = (found.where(~F.array_contains(F.col("known"), F.lower("name"))).groupBy("EXTRACT_TYPE", F.lower("name").alias("low"))
             .agg(F.min(F.struct("at", "name")).alias("first")).collect()) if keep_undeclared else []
    # Whether lines are records of their own in some file: where all files have open quotes, no pass over lines is needed.
    by_line = F.count_if(F.col("readable") & ((F.col("route") == ROUTE_TOLERANT) | (F.col("n_open") == 0)))
    counts = routed.groupBy("EXTRACT_TYPE").agg(F.count_if("readable"), by_line).collect()
    held, by_line = {r[0]: r[1] for r in counts}, {r[0]: r[2] for r in counts}
    extras = {et: [r["first"]["name"] for r in sorted((r for r in extra if r["EXTRACT_TYPE"] == et), key=lambda r: r["first"])] for et in S.EXTRACT_TYPES}

    def places(et: str) -> Column:
        exact = F.transform(F.array(*[F.lit(c) for c in S.declared_columns(et)]), lambda c: _position(F.col("names"), F.col("route"), c))
        if not extras[et]:
            return exact
        low = F.transform("names", lower)
        return F.concat(exact, F.transform(F.array(*[F.lit(c.lower()) for c in extras[et]]), lambda c: _position(low, F.col("route"), c)))

    at = F.when(F.col("EXTRACT_TYPE") == S.QUESTIONS, places(S.QUESTIONS)).otherwise(places(S.SCORING))
    table = routed.where("readable").select("FILE_NAME", "EXTRACT_TYPE", "header_mid", (F.col("route") == ROUTE_TOLERANT).alias("tolerant"),
                                            (F.col("n_open") > 0).alias("open"), at.alias("at"))
    about = [c for c in S.FILE_METADATA_COLUMNS if c != "FILE_NAME"] if with_metadata else []
    if about:
        table = table.select(*file_metadata_columns(F.col("FILE_NAME")), *[c for c in table.columns if c not in S.FILE_METADATA_COLUMNS])
    table = _sized_broadcast(table, n_files, max(len(S.declared_columns(et)) + len(extras[et]) for et in S.EXTRACT_TYPES))
    keep = ["FILE_NAME", *about, "tolerant", "at"]
    blank = Q.is_blank(F.col("value"))
    open_files = routed.where(f"readable AND n_open > 0 AND route = '{ROUTE_STRICT}'").select("FILE_NAME").distinct()
    out = {}
    for et in S.EXTRACT_TYPES:
        columns = S.declared_columns(et) + extras[et]

        def rows_of(placed: DataFrame | None) -> DataFrame:
            split = None
            if by_line.get(et) or placed is None:
                bound = text[et].join(table, "FILE_NAME").where("mid <> header_mid AND (tolerant OR NOT open)")
                bound = bound.where(~blank if skip_blank else F.col("tolerant") | ~blank)
                split = bound.select(*keep, F.when(F.col("tolerant"), clean_split(F.col("value"), sep)).otherwise(Q.fields(F.col("value"), sep)).alias("fields"))
            if placed is not None:
                whole = Q.records(placed).join(table, "FILE_NAME").where("rec_mid <> header_mid AND NOT tolerant")
                whole = whole.select(*keep, Q.fields(F.col("value"), sep).alias("fields"))
                split = whole if split is None else split.unionByName(whole)
            values = [F.get("fields", F.get("at", i)) for i in range(len(columns))]
            return split.select("FILE_NAME", *about, *[F.when(F.col("tolerant"), v).otherwise(na_to_null(v)).alias(c) for c, v in zip(columns, values)])

        status = routed.where(F.col("EXTRACT_TYPE") == et).select(
            "FILE_NAME", "route", F.concat("read_errors", F.coalesce(F.array_compact(F.array("missing")), F.array().cast(_NO_ERRORS))).alias("read_errors"),
            "readable", "content_hash")
        out[et] = ScanResult(None, status, folder=folders.get(et) if keep_lines else None)
        if held.get(et):
            only = _sized_broadcast(open_files, n_files, 0)
            out[et].rows = rows_of(Q.states(effects[et].join(only, "FILE_NAME"), parts)[0] if et in opened else None)
            if keep_lines and et in opened:
                out[et].stored = rows_of(Q.placed(lines[et].join(only, "FILE_NAME"), splits[et])[0])
    return out


def scan_extracts(spark: SparkSession, manifest: DataFrame, extract_type: str, sep: str = S.SEPARATOR,
                  keep_undeclared: bool = True, skip_blank: bool = False) -> ScanResult:
    """S4 for one extract type."""
    return scan_all(spark, manifest.where(F.col("EXTRACT_TYPE") == extract_type), sep, keep_undeclared, skip_blank)[extract_type]


def scan_strict(spark: SparkSession, path: str, sep: str = S.SEPARATOR) -> DataFrame:
    """S2 for one file: its records by the quote rules, named by its header; NA tokens become null."""
    effects = Q.with_effects(Q.read_lines(spark, [path]), sep)
    head = file_stats(effects).select("header_mid", header_names(F.col("header"), F.lit(False), sep).alias("names")).first()
    placed, _ = Q.states(effects)
    rows = Q.records(placed).where(F.col("rec_mid") != head["header_mid"]).select(Q.fields(F.col("value"), sep).alias("f"))
    return rows.select(*[na_to_null(F.get("f", F.lit(i))).alias(n) for i, n in enumerate(head["names"])])


def scan_tolerant(spark: SparkSession, path: str, sep: str = S.SEPARATOR) -> DataFrame:
    """S3 for one file: each line split on the raw separator, fields stripped of outer quotes; extra fields
    are dropped, missing ones null, a repeated header name keeps its last place, a blank line is one empty field."""
    lines = Q.read_lines(spark, [path])
    head = file_stats(Q.with_effects(lines, sep)).select("header_mid", clean_split(F.col("header"), sep).alias("names")).first()
    at = {n: i for i, n in enumerate(head["names"])}
    rows = lines.where(F.col("mid") != head["header_mid"]).select(clean_split(F.col("value"), sep).alias("f"))
    return rows.select(*[F.get("f", F.lit(at[n])).alias(n) for n in dict.fromkeys(head["names"])])
