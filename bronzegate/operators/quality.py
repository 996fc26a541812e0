"""Value-set checks between two tables.

Design: the relation of two value sets is decided by ONE aggregation over the
union of both sides' values, each tagged with a side flag:

    left  -> (group..., [column], value, in_left=1, in_right=0)
    right -> (group..., [column], value, in_left=0, in_right=1)
    groupBy(group..., [column], value).agg(max(in_left), max(in_right))   # partial agg map-side
    groupBy(group...).agg(count_if(left only), count_if(right only))  # tiny

Partial (map-side) aggregation collapses hot values before the shuffle, so a
value or group that holds a third of all rows costs one row per map task. The
value differences themselves (J2) stay lazy DataFrames and are never collected.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import ColCheckOnEmptyDF, ColCheckOnMissingCol
from .models import (
    BOTH,
    COL_MISSING,
    DF_EMPTY,
    LEFT_NOT_RIGHT,
    RIGHT_NOT_LEFT,
    ColumnDomainRelationship,
    ColumnDomainResult,
    relation_from_counts,
)

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _kind(dt: T.DataType) -> str:
    if isinstance(dt, _INTEGRAL + _FRACTIONAL):
        return "numeric"
    return dt.simpleString()


def _as_decimal(dt: T.DataType) -> T.DecimalType:
    return dt if isinstance(dt, T.DecimalType) else T.DecimalType(19, 0)


def _unified_type(lt: T.DataType, rt: T.DataType) -> T.DataType | None:
    """Common comparison type, or None when the two sides can never match.

    Equal types compare as themselves; integers and decimals exactly, in a decimal
    wide enough for both; a float or double on one side makes it DOUBLE, as do
    decimals that no 38 digits can hold together. Any other type must be the same
    on both sides (a number never equals its text).
    """
    if lt == rt:
        return lt
    if isinstance(lt, _INTEGRAL) and isinstance(rt, _INTEGRAL):
        return T.LongType()
    exact = _INTEGRAL + (T.DecimalType,)
    if isinstance(lt, exact) and isinstance(rt, exact):
        a, b = _as_decimal(lt), _as_decimal(rt)
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    if _kind(lt) == "numeric" and _kind(rt) == "numeric":
        return T.DoubleType()
    return None


def _canonical(c: Column, dt: T.DataType, target: T.DataType) -> Column:
    """Value cast to the comparison type; float NaN folds into null, -0.0 into 0.0."""
    out = c.cast(target)
    if isinstance(target, (T.FloatType, T.DoubleType)):
        out = F.when(F.isnan(out), F.lit(None).cast(target)).when(out == 0, F.lit(0.0).cast(target)).otherwise(out)
    return out


def _field_type(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


def _plan_columns(cols: Sequence[str], left: DataFrame, right: DataFrame):
    """Per column: (name, left value, right value, left kind, right kind), one value type.

    ``kind`` is 0 when both sides share a comparison type; when they cannot
    match (e.g. text vs number) the sides get kinds 1 and 2 so no value is
    shared. Values of different columns are cast to text only when the
    columns' comparison types differ.
    """
    plans = [(c, _field_type(left, c), _field_type(right, c)) for c in cols]
    plans = [(c, lt, rt, _unified_type(lt, rt)) for c, lt, rt in plans]
    targets = {p[3] for p in plans}
    value_type = next(iter(targets)) if len(targets) == 1 and None not in targets else T.StringType()
    out = []
    for c, lt, rt, target in plans:
        if target is None:
            v = F.col(f"`{c}`").cast(T.StringType())
            out.append((c, v, v, 1, 2))
        else:
            out.append((c, _canonical(F.col(f"`{c}`"), lt, target).cast(value_type),
                        _canonical(F.col(f"`{c}`"), rt, target).cast(value_type), 0, 0))
    return out, value_type


def _stack(df: DataFrame, parts, side: str, group_cols: Sequence[str], multi: bool) -> DataFrame:
    """One row per (input row, checked column): group cols, [column], kind, value, side flag."""
    left = side == "left"
    in_l = F.lit(1 if left else 0).cast("tinyint").alias("in_left")
    in_r = F.lit(0 if left else 1).cast("tinyint").alias("in_right")
    base = [F.col(f"`{g}`") for g in group_cols]
    if not multi:
        c, lv, rv, lk, rk = parts[0]
        return df.select(*base, F.lit(lk if left else rk).cast("tinyint").alias("kind"),
                         (lv if left else rv).alias("value"), in_l, in_r)
    structs = [F.struct(F.lit(c).alias("column_name"), F.lit(lk if left else rk).cast("tinyint").alias("kind"),
                        (lv if left else rv).alias("value"))
               for c, lv, rv, lk, rk in parts]
    return df.select(*base, F.inline(F.array(*structs)), in_l, in_r)


def value_flags(left: DataFrame, right: DataFrame, cols: Sequence[str],
                group_cols: Sequence[str] = ()) -> DataFrame:
    """Distinct values per (group, column) with side flags: the shared core of E2-E4, J3.

    Output: group cols, column_name, kind, value, in_left, in_right. The column
    name and kind join the grouping key only when they vary (several columns,
    mismatched types); otherwise they are added after the aggregation.
    """
    parts, _ = _plan_columns(cols, left, right)
    multi = len(parts) > 1
    mismatch = any(p[3] != p[4] for p in parts)
    both = _stack(left, parts, "left", group_cols, multi).unionByName(
        _stack(right, parts, "right", group_cols, multi))
    keys = [*group_cols] + (["column_name"] if multi else []) + (["kind"] if mismatch else []) + ["value"]
    agg = both.groupBy(*keys).agg(F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right"))
    if not multi:
        agg = agg.withColumn("column_name", F.lit(parts[0][0]))
    if not mismatch:
        agg = agg.withColumn("kind", F.lit(0).cast("tinyint"))
    return agg.select(*group_cols, "column_name", "kind", "value", "in_left", "in_right")


def _relation_expr(n_l: Column, n_r: Column) -> Column:
    return (F.when((n_l > 0) & (n_r > 0), F.lit("BOTH"))
             .when(n_l > 0, F.lit("LEFT_NOT_RIGHT"))
             .when(n_r > 0, F.lit("RIGHT_NOT_LEFT"))
             .otherwise(F.lit("EQUAL")))


def summarize_flags(flags: DataFrame, group_cols: Sequence[str] = (), column: str | None = None) -> DataFrame:
    """Per (group, column): distinct counts per side, one-sided counts, relation.

    With ``column`` given (a single checked column) the aggregation is keyed
    by the group columns only (global when there are none) and the column
    name is added afterwards, instead of grouping by a constant.
    """
    lo = (F.col("in_left") == 1) & (F.col("in_right") == 0)
    ro = (F.col("in_right") == 1) & (F.col("in_left") == 0)
    aggs = [
        F.sum(F.col("in_left").cast("long")).alias("n_left_distinct"),
        F.sum(F.col("in_right").cast("long")).alias("n_right_distinct"),
        F.count_if(lo).alias("n_left_only"),
        F.count_if(ro).alias("n_right_only"),
    ]
    if column is None:
        agg = flags.groupBy(*group_cols, "column_name").agg(*aggs)
    else:
        grouped = flags.groupBy(*group_cols) if group_cols else flags.groupBy()
        agg = grouped.agg(*aggs).select(*group_cols, F.lit(column).alias("column_name"),
                                        "n_left_distinct", "n_right_distinct", "n_left_only", "n_right_only")
        if not group_cols:
            # A global aggregate always yields a row; keep "no values at all" as no row.
            agg = agg.where(F.col("n_left_distinct").isNotNull())
    return agg.withColumn("relation", _relation_expr(F.col("n_left_only"), F.col("n_right_only")))


def value_set_summary(left: DataFrame, right: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """E2/E4 as a lazy DataFrame: one row per checked column.

    Columns: column, n_left_distinct, n_right_distinct, n_left_only, n_right_only, relation.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    return summarize_flags(value_flags(left, right, cols), column=cols[0] if len(cols) == 1 else None)


def value_diff(left: DataFrame, right: DataFrame, col: str, right_col: str | None = None,
               keep: str | Sequence[str] | None = None) -> DataFrame:
    """Rows of ``left`` whose ``col`` value is absent from ``right`` (duplicates kept).

    Null matches null. Numbers compare by value across widths; other types must
    be equal, otherwise every left row is returned. ``keep`` selects the output
    columns (default: all of ``left``).
    """
    right_col = right_col or col
    lt, rt = _field_type(left, col), _field_type(right, right_col)
    out_cols = left.columns if keep is None else ([keep] if isinstance(keep, str) else list(keep))
    target = _unified_type(lt, rt)
    if target is None:
        return left.select(*[F.col(f"`{c}`") for c in out_cols])
    key = "__bg_key"
    lk = left.withColumn(key, _canonical(F.col(f"`{col}`"), lt, target))
    # Deduplicate the probe side first: partial aggregation shrinks it before the shuffle.
    rk = right.select(_canonical(F.col(f"`{right_col}`"), rt, target).alias(key)).distinct()
    joined = lk.join(rk, lk[key].eqNullSafe(rk[key]), "left_anti")
    return joined.select(*[F.col(f"`{c}`") for c in out_cols])


def uncovered_values(flags: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """J3 in long form: one row per one-sided value: group..., column, side, value.

    ``side`` is ``left`` when only the left holds the value. Kept long (never one
    list per group), so a group with a third of all values still spreads over
    many tasks.
    """
    one_sided = flags.where(F.col("in_left") != F.col("in_right"))
    return one_sided.select(
        *group_cols, "column_name",
        F.when(F.col("in_left") == 1, F.lit("left")).otherwise(F.lit("right")).alias("side"),
        "value",
    )


# ---------------------------------------------------------------------------
# Python-level check with the pre-flight errors (E5) and a result object
# ---------------------------------------------------------------------------

def _is_empty(df: DataFrame) -> bool:
    return len(df.columns) == 0 or df.isEmpty()


def _holder(faulty_left: bool, faulty_right: bool) -> ColumnDomainRelationship:
    """Which side has what the faulty side lacks; ``BOTH`` when each is faulty."""
    return {(True, False): RIGHT_NOT_LEFT, (False, True): LEFT_NOT_RIGHT, (True, True): BOTH}[faulty_left, faulty_right]


def preflight(cols: str | Sequence[str], left: DataFrame, right: DataFrame) -> None:
    """E5: an empty side is an error, and tested first; then a column that a side lacks."""
    empty = [_is_empty(side) for side in (left, right)]
    if any(empty):
        raise ColCheckOnEmptyDF(ColumnDomainResult(_holder(*empty) | DF_EMPTY))
    wanted = [cols] if isinstance(cols, str) else list(cols)
    lacking = [[c for c in wanted if c not in side.columns] for side in (left, right)]
    if any(lacking):
        # A single name is reported as such, several as lists; each under the side that has them.
        named = [(names[0] if isinstance(cols, str) else names) if names else None for names in lacking]
        relation = _holder(*map(bool, lacking)) | COL_MISSING
        raise ColCheckOnMissingCol(ColumnDomainResult(relation, lnotr=named[1], rnotl=named[0]))


def check_column_value_sets(cols: str | list[str] | tuple[str, ...], left: DataFrame,
                            right: DataFrame):
    """Compare the value sets of ``cols`` in ``left`` and ``right``.

    A single name returns one ``ColumnDomainResult``; a list/tuple returns a
    dict per column. All columns are decided by one aggregation job that
    returns one small row per column; ``lnotr``/``rnotl`` are lazy DataFrames of
    the differing values with duplicates kept.
    """
    preflight(cols, left, right)
    names = [cols] if isinstance(cols, str) else list(cols)
    rows = {r["column_name"]: r for r in value_set_summary(left, right, names).collect()}
    results = {}
    for c in names:
        r = rows[c]
        rel = relation_from_counts(r["n_left_only"], r["n_right_only"])
        lnotr = value_diff(left, right, c, keep=c) if r["n_left_only"] else None
        rnotl = value_diff(right, left, c, keep=c) if r["n_right_only"] else None
        results[c] = ColumnDomainResult(rel, lnotr, rnotl)
    return results[cols] if isinstance(cols, str) else results

