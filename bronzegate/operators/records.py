"""Per-file and per-pair records: E1 rollup, P9 null report, J1 pairing, E3 ID check,
E6 outcome, P10 domain report, and the ingestion log assembly.

All inputs and outputs are DataFrames. Per-file / per-pair tables are small
(one row per raw file), but they are still built and joined by Spark.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import accepted, col, pair_key
from .conform import BAD_PREFIX, NULL_PREFIX
from ..session import broadcast_if_small
from .quality import summarize_flags, value_flags



#: Groups that a pair's IDs are dealt to before their smallest are gathered.
SALTS = 64


def _empty_errors() -> Column:
    return F.array().cast("array<string>")



def _errors(*maybe: Column) -> Column:
    """Array of the non-null texts, in order."""
    return F.array_compact(F.array(*maybe))


# --- E1 + value failures + P9 ------------------------------------------------

def file_rollup(conformed: DataFrame) -> DataFrame:
    """One aggregation per file: N_ROWS and exact distinct counts (after the fill),
    failed-conversion counts per typed column and null counts per string column
    (before the fill). Exact ``count(DISTINCT)``, never an approximation.
    """
    bad = [c for c in conformed.columns if c.startswith(BAD_PREFIX)]
    nulls = [c for c in conformed.columns if c.startswith(NULL_PREFIX)]
    aggs = [
        F.count(F.lit(1)).alias("N_ROWS"),
        F.count_distinct(col(S.RESIDENT_COLUMN)).alias("N_RESIDENTS"),
        F.count_distinct(col(S.FACILITY_COLUMN)).alias("N_FACILITIES"),
        F.count_distinct(col(S.ID_COLUMN)).alias("N_UNIQUE_ASSESSMENTS"),
    ]
    aggs += [F.count_if(col(c)).alias(c) for c in bad + nulls]
    out = conformed.groupBy("FILE_NAME").agg(*aggs)
    conv_errors = [
        F.when(col(c) > 0, F.format_string(
            "%d value(s) of %s could not be converted", col(c), F.lit(c[len(BAD_PREFIX):])))
        for c in bad
    ]
    out = out.withColumn("value_errors", _errors(*conv_errors) if conv_errors else _empty_errors())
    return out


def null_report(rollup: DataFrame) -> DataFrame:
    """(FILE_NAME, column, nulls, n, severity) for every string column with nulls.

    WARNING when every value is missing, INFO when some are.
    """
    nulls = [c for c in rollup.columns if c.startswith(NULL_PREFIX)]
    if not nulls:
        return rollup.sparkSession.createDataFrame(
            [], "FILE_NAME string, column_name string, nulls bigint, n bigint, severity string")
    long = rollup.select("FILE_NAME", F.col("N_ROWS").alias("n"), F.inline(F.array(*[
        F.struct(F.lit(c[len(NULL_PREFIX):]).alias("column_name"), col(c).alias("nulls")) for c in nulls])))
    return (long.where(F.col("nulls") > 0)
            .select("FILE_NAME", "column_name", "nulls", "n",
                    F.when(F.col("nulls") == F.col("n"), F.lit("WARNING")).otherwise(F.lit("INFO"))
                    .alias("severity")))


# --- J1 ------------------------------------------------------------------------

def pair_files(manifest: DataFrame) -> DataFrame:
    """Full-outer key join of Questions and Scoring files.

    Columns: PAIR_KEY, Q_FILE, S_FILE, PAIR_STATUS (PAIRED / UNPAIRED).
    The key is the file name with ``Scoring`` removed, so the result does not
    depend on any sort order.
    """
    m = manifest.select("FILE_NAME", "EXTRACT_TYPE", pair_key(F.col("FILE_NAME")).alias("PAIR_KEY"))
    q = m.where(F.col("EXTRACT_TYPE") == S.QUESTIONS).select("PAIR_KEY", F.col("FILE_NAME").alias("Q_FILE"))
    s = m.where(F.col("EXTRACT_TYPE") == S.SCORING).select("PAIR_KEY", F.col("FILE_NAME").alias("S_FILE"))
    return (q.join(s, "PAIR_KEY", "full_outer")
            .withColumn("PAIR_STATUS", F.when(F.col("Q_FILE").isNotNull() & F.col("S_FILE").isNotNull(),
                                              F.lit("PAIRED")).otherwise(F.lit("UNPAIRED"))))


# --- E3 ------------------------------------------------------------------------

def _with_pair_key(df: DataFrame) -> DataFrame:
    return df.select(pair_key(F.col("FILE_NAME")).alias("PAIR_KEY"), col(S.ID_COLUMN))


def pair_id_flags(questions: DataFrame, scoring: DataFrame) -> DataFrame:
    """Distinct IDs per pair with side flags (left = Questions, right = Scoring)."""
    return value_flags(_with_pair_key(questions), _with_pair_key(scoring), [S.ID_COLUMN], ["PAIR_KEY"])


def pair_id_check(questions: DataFrame, scoring: DataFrame) -> DataFrame:
    """Per pair, the ID relation; one pass over all pairs, never a job per pair.

    Columns: PAIR_KEY, n_left_distinct, n_right_distinct, n_left_only, n_right_only, relation.
    """
    return summarize_flags(pair_id_flags(questions, scoring), ["PAIR_KEY"], column=S.ID_COLUMN).drop("column_name")


def uncovered_ids(questions: DataFrame, scoring: DataFrame, pairs: DataFrame,
                  n_pairs: int | None = None, max_broadcast_pairs: int = 1_000_000) -> DataFrame:
    """J3 (long form): FILE_WITH, FILE_WITHOUT, MISSING_ID for every one-sided ID.

    The pair table has one row per delivery. With a known bound ``n_pairs``
    within ``max_broadcast_pairs`` it is broadcast, so the one-sided IDs are
    never shuffled by pair key; otherwise AQE picks the join from measured
    sizes at runtime (converting to a broadcast or splitting a skewed pair).
    """
    flags = pair_id_flags(questions, scoring).where(F.col("in_left") != F.col("in_right"))
    p = pairs.select("PAIR_KEY", "Q_FILE", "S_FILE")
    if n_pairs is not None:
        p = broadcast_if_small(p, max_broadcast_pairs, known_rows=n_pairs)
    j = flags.join(p, "PAIR_KEY")
    q_has = F.col("in_left") == 1
    return j.select(
        "PAIR_KEY",
        F.when(q_has, F.col("Q_FILE")).otherwise(F.col("S_FILE")).alias("FILE_WITH"),
        F.when(q_has, F.col("S_FILE")).otherwise(F.col("Q_FILE")).alias("FILE_WITHOUT"),
        F.col("value").alias("MISSING_ID"))


def uncovered_id_lists(uncovered: DataFrame, cap: int = 20) -> DataFrame:
    """J3 (list form): FILE_WITH, FILE_WITHOUT, the ``cap`` smallest missing IDs and how many there are.

    Ranks are found per task first (a pair's rows are dealt to ``SALTS`` groups by ID, each of which keeps
    its ``cap`` smallest), so no step gathers a pair: what reaches the last one is ``cap`` rows a group.
    """
    by = ["FILE_WITH", "FILE_WITHOUT"]
    salted = uncovered.withColumn("salt", F.pmod(F.xxhash64("MISSING_ID"), F.lit(SALTS)))
    counts = uncovered.groupBy(*by).agg(F.count("*").alias("n_missing"))
    rank = F.row_number().over(Window.partitionBy(*by, "salt").orderBy("MISSING_ID"))
    some = salted.withColumn("r", rank).where(F.col("r") <= cap).drop("r")
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("MISSING_ID"))
    least = some.withColumn("r", rank).where(F.col("r") <= cap)
    lists = least.groupBy(*by).agg(F.array_sort(F.collect_list("MISSING_ID")).alias("MISSING_IDS"))
    same = F.col("l.FILE_WITH").eqNullSafe(F.col("c.FILE_WITH")) & F.col("l.FILE_WITHOUT").eqNullSafe(F.col("c.FILE_WITHOUT"))
    return lists.alias("l").join(counts.alias("c"), same).select("l.FILE_WITH", "l.FILE_WITHOUT", "MISSING_IDS", "n_missing")


# --- E1 state that merges over batches -----------------------------------------

STATE_COLUMNS = {"N_RESIDENTS": S.RESIDENT_COLUMN, "N_FACILITIES": S.FACILITY_COLUMN, "N_UNIQUE_ASSESSMENTS": S.ID_COLUMN}


def value_dictionary(conformed: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(kind, value, id): a dense number for every value of the counted columns, kept for the values already ``known``."""
    pairs = conformed.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), col(c).alias("value")) for k, c in STATE_COLUMNS.items()])))
    pairs = pairs.distinct()
    first = F.lit(0)
    if known is not None:
        pairs = pairs.join(known.select("kind", "value"), ["kind", "value"], "left_anti")
        first = F.lit(known.agg(F.coalesce(F.max("id") + 1, F.lit(0))).first()[0])
    # Dense within a group of hashes, interleaved over the groups: ids stay below groups times the largest group.
    group = F.pmod(F.xxhash64("kind", "value"), F.lit(SALTS))
    nth = F.row_number().over(Window.partitionBy("g").orderBy("kind", "value")) - 1
    fresh = pairs.withColumn("g", group).select("kind", "value", (first + nth * SALTS + F.col("g")).cast("long").alias("id"))
    return fresh if known is None else known.select("kind", "value", "id").unionByName(fresh)


def rollup_state(conformed: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(FILE_NAME, kind, bucket, bits): per file and counted column, the bitmap of its values' numbers.

    States of several batches merge by OR (``merge_states``) and count exactly (``state_counts``).
    """
    pairs = conformed.select("FILE_NAME", F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), col(c).alias("value")) for k, c in STATE_COLUMNS.items()])))
    ids = pairs.distinct().join(dictionary, ["kind", "value"])
    return ids.groupBy("FILE_NAME", "kind", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merge_states(*states: DataFrame) -> DataFrame:
    whole = reduce(lambda a, b: a.unionByName(b), states)
    return whole.groupBy("FILE_NAME", "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def state_counts(state: DataFrame) -> DataFrame:
    """FILE_NAME and the exact distinct counts N_RESIDENTS, N_FACILITIES, N_UNIQUE_ASSESSMENTS."""
    n = F.bitmap_count("bits")
    return state.groupBy("FILE_NAME").agg(*[F.sum(F.when(F.col("kind") == k, n).otherwise(0)).alias(k) for k in STATE_COLUMNS])


# --- E6 ------------------------------------------------------------------------

def file_read_metadata(status: DataFrame, rollup: DataFrame) -> DataFrame:
    """Per file: counts (-1 when unreadable), READ_ERRORS, READ_SUCCESS.

    A file is unreadable when the scan could not bind it, or any typed value
    failed to convert. A readable file without rows has zero counts.
    """
    j = status.join(rollup, "FILE_NAME", "left")
    value_errors = F.coalesce(F.col("value_errors"), _empty_errors())
    ok = F.col("readable") & (F.size(value_errors) == 0)
    def cnt(c: str) -> Column:
        return F.when(ok, F.coalesce(F.col(c), F.lit(0).cast("long"))).otherwise(F.lit(-1).cast("long")).alias(c)
    return j.select("FILE_NAME", cnt("N_ROWS"), cnt("N_RESIDENTS"), cnt("N_FACILITIES"),
                    cnt("N_UNIQUE_ASSESSMENTS"),
                    F.concat(F.col("read_errors"), value_errors).alias("READ_ERRORS"),
                    ok.alias("READ_SUCCESS"))


def ingest_outcome(pairs: DataFrame, read_meta: DataFrame, id_check: DataFrame, skip_unequal: bool = False) -> DataFrame:
    """E6 per pair -> two log rows (one per file) with INGEST_ERRORS / INGEST_SUCCESS.

    * either side unreadable -> both fail, error names the unreadable file(s)
    * either side without rows -> both fail, empty-side message
    * unequal ID sets -> error text recorded, files still pass (unless ``skip_unequal``)
    * INGEST_SUCCESS is whether the file is written (Scoring only with its Questions)
    """
    paired = pairs.where(F.col("PAIR_STATUS") == "PAIRED")
    q = read_meta.select(*[F.col(c).alias("q_" + c) for c in read_meta.columns])
    s = read_meta.select(*[F.col(c).alias("s_" + c) for c in read_meta.columns])
    j = (paired.join(q, paired.Q_FILE == q.q_FILE_NAME, "left")
               .join(s, paired.S_FILE == s.s_FILE_NAME, "left")
               .join(id_check.select("PAIR_KEY", "relation"), "PAIR_KEY", "left"))
    left = F.format_string(S.MSG_LEFT_LABEL.replace("{name}", "%s"), F.col("Q_FILE"))
    right = F.format_string(S.MSG_RIGHT_LABEL.replace("{name}", "%s"), F.col("S_FILE"))

    def fmt(tmpl: str, **cols: Column) -> Column:
        order = [name for name in ("left", "right", "rel") if "{" + name + "}" in tmpl]
        order.sort(key=lambda n: tmpl.index("{" + n + "}"))
        return F.format_string(tmpl.replace("{left}", "%s").replace("{right}", "%s").replace("{rel}", "%s"),
                               *[cols[n] for n in order])

    q_ok = F.coalesce(F.col("q_READ_SUCCESS"), F.lit(False))
    s_ok = F.coalesce(F.col("s_READ_SUCCESS"), F.lit(False))
    q_empty, s_empty = F.col("q_N_ROWS") == 0, F.col("s_N_ROWS") == 0
    unreadable = F.array_compact(F.array(
        F.when(~q_ok, F.concat(F.lit("unreadable: "), F.col("Q_FILE"))),
        F.when(~s_ok, F.concat(F.lit("unreadable: "), F.col("S_FILE")))))
    errs = (F.when(~q_ok | ~s_ok, unreadable)
             .when(q_empty & s_empty, F.array(fmt(S.MSG_EMPTY_BOTH, left=left, right=right)))
             .when(q_empty, F.array(fmt(S.MSG_EMPTY_LEFT, left=left, right=right)))
             .when(s_empty, F.array(fmt(S.MSG_EMPTY_RIGHT, left=left, right=right)))
             .when(F.col("relation") != "EQUAL",
                   F.array(fmt(S.MSG_IDS_UNEQUAL, left=left, right=right, rel=F.col("relation"))))
             .otherwise(_empty_errors()))
    success = q_ok & s_ok & ~q_empty & ~s_empty
    per_pair = j.select("PAIR_KEY", "Q_FILE", "S_FILE", errs.alias("INGEST_ERRORS"),
                        success.alias("INGEST_SUCCESS"), (success & (F.col("relation") != "EQUAL")).alias("unequal"))
    return per_pair.select("INGEST_ERRORS", (F.col("INGEST_SUCCESS") & ~(F.lit(skip_unequal) & F.coalesce("unequal", F.lit(False)))).alias("INGEST_SUCCESS"),
                           F.explode(F.array("Q_FILE", "S_FILE")).alias("FILE_NAME"))


def unpaired_outcome(pairs: DataFrame) -> DataFrame:
    """Quarantined files: never read, logged with an error."""
    up = pairs.where(F.col("PAIR_STATUS") == "UNPAIRED")
    return up.select(F.array(F.lit("unpaired: no matching file")).alias("INGEST_ERRORS"),
                     F.lit(False).alias("INGEST_SUCCESS"),
                     F.coalesce("Q_FILE", "S_FILE").alias("FILE_NAME"))


def ingestion_log(manifest: DataFrame, read_meta: DataFrame, outcome: DataFrame,
                  processed_ts: Column | None = None) -> DataFrame:
    """Assemble the log rows in the fixed column order (S8 schema)."""
    m = manifest.select(*S.FILE_METADATA_COLUMNS)
    j = m.join(outcome, "FILE_NAME", "inner").join(read_meta, "FILE_NAME", "left")
    neg = F.lit(-1).cast("long")
    ts = processed_ts if processed_ts is not None else F.localtimestamp()
    return j.select(
        "FILE_NAME", "FILE_DATE", "INSTANCE", "PROVINCE", "EXTRACT_TYPE",
        *[F.coalesce(F.col(c), neg).alias(c) for c in
          ("N_ROWS", "N_RESIDENTS", "N_FACILITIES", "N_UNIQUE_ASSESSMENTS")],
        F.coalesce("READ_ERRORS", _empty_errors()).alias("READ_ERRORS"),
        F.coalesce("READ_SUCCESS", F.lit(False)).alias("READ_SUCCESS"),
        "INGEST_ERRORS", "INGEST_SUCCESS", ts.cast("timestamp_ntz").alias("PROCESSED_TIMESTAMP"))


# --- P10 -------------------------------------------------------------------------

def domain_report(manifest: DataFrame) -> DataFrame:
    """P10: per metadata column, the number of values outside the accepted domain."""
    aggs = [F.count_if(F.col(c).isNotNull() & accepted(F.col(c), dom).isNull()).alias(c)
            for c, dom in S.DOMAINS.items()]
    r = manifest.agg(*aggs)
    return r.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in S.DOMAINS])))


def apply_domains(manifest: DataFrame) -> DataFrame:
    """P10 applied: out-of-domain metadata values become null."""
    return manifest.select(*[accepted(F.col(c), S.DOMAINS[c]).alias(c) if c in S.DOMAINS else F.col(c)
                             for c in manifest.columns])


