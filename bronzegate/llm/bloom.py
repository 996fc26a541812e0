"""A blocked Bloom filter as a table, and the joins that ask it first.

The filter is a table (block, 64-bit word): one block per key, five bits in its word.  All of
it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzegate.llm.common import BROADCAST_ROWS, Stages, small

KEYS_PER_WORD = 5
FILTER_ROWS = 1_000_000


def bits(key: Column) -> Column:
    """The key's bits in its word: five six-bit slices of a second hash."""
    h = F.xxhash64(F.lit(7), key)
    out = F.lit(0).cast("long")
    for i in range(5):
        slot = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), slot))
    return out


def bloom(keys: DataFrame, n_keys: int, most: int | None = None) -> tuple[DataFrame, int]:
    """Blocked Bloom filter of the column ``key``: (block, word), and its block count, ``most`` at most."""
    blocks = max(1, -(-n_keys // KEYS_PER_WORD))
    blocks = blocks if most is None else min(blocks, most)
    return (
        keys.groupBy(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block")).agg(F.bit_or(bits(F.col("key"))).alias("word")),
        blocks,
    )


def _possible(rows: DataFrame, ids: DataFrame, n: int, column: str, stages: Stages) -> DataFrame:
    """The ``rows`` whose ``column`` passes the filter of the ``n`` ids, with the filter's columns."""
    key = F.col(column)
    words, blocks = bloom(ids.select(key.alias("key")), n, FILTER_ROWS)
    words = stages.save(words.select(F.col("block").alias("__block"), F.col("word").alias("__word")), "bloom")
    possible = rows.join(F.broadcast(words), F.pmod(F.xxhash64(key), F.lit(blocks)) == F.col("__block"))
    return possible.where(F.col("__word").bitwiseAND(bits(key)) == bits(key))


def having(rows: DataFrame, ids: DataFrame, column: str, stages: Stages) -> DataFrame:
    """The ``rows`` whose ``column`` is in ``ids`` (of that one column, without repeats).

    Up to ``BROADCAST_ROWS`` counted ids are broadcast, so no row moves.  More of them take a filter, broadcast too and of
    bounded size, and only the rows that pass it (those wanted, and about one in a hundred of the others while
    the ids are at most ``KEYS_PER_WORD * FILTER_ROWS``) move to the exact join.
    """
    n = ids.count()
    if n > BROADCAST_ROWS:
        # An inner join follows: a semi join would be moved to before the filter.
        return _possible(rows, ids, n, column, stages).join(ids, column).select(*rows.columns)
    return rows.join(small(ids, n), column, "left_semi")


def meeting(rows: DataFrame, facts: DataFrame, column: str, stages: Stages) -> DataFrame:
    """The ``rows`` joined with ``facts``, a stored table of one row per value of ``column``; rows move as in ``having``."""
    n = facts.count()
    if n > BROADCAST_ROWS:
        return _possible(rows, facts, n, column, stages).drop("__block", "__word").join(facts, column)
    return rows.join(small(facts, n), column)
