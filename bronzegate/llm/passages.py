"""Steps that both passage operators share: named surroundings, attached words, split buckets.

A passage of ``size`` words that two documents share holds the same minimiser, the least
hash of ``m`` consecutive words, in both.  So only places whose minimiser occurs in two
documents or more need their words; the rest end as a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzegate.llm import words as W
from bronzegate.llm.bloom import meeting
from bronzegate.llm.common import Stages

#: A bucket with more different texts than this is resolved window by window instead.
HOT = 256


def plain_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, text): null text is empty; ``row`` tells texts of a repeated id apart."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(body).alias("row"), body.alias("text"))


def minimisers(hashes: np.ndarray, size: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of the minimiser of each window of ``size`` words, and the hashes of all places."""
    keys = W.windows(hashes, m)
    span = size - m + 1
    n = len(keys) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), keys
    return np.lib.stride_tricks.sliding_window_view(keys, span).argmin(1) + np.arange(n), keys


def _names(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, anchor: np.ndarray) -> list[np.ndarray]:
    """128 bits that stand for the words from ``a`` to ``b`` and the anchor in them, as two arrays."""
    up, down = W.powers(len(hashes) + 1)
    out = []
    for h in (hashes, W.mix(hashes ^ np.uint64(0xA5A5A5A5))):
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up[: len(h)], out=sums[1:])
        out.append(W.mix(W.mix((sums[b] - sums[a]) * down[a]) + ((b - a) << 32 | anchor).astype(np.uint64)).view(np.int64))
    return out


def places(rows: DataFrame, cut, extent) -> DataFrame:
    """(id, row, key, from, n, anchor, p1, p2) per place: its text is ``n`` words from ``from``, named by p1 and p2.

    ``cut(word hashes)`` gives keys, starts and counts of a document, ``extent(starts, counts, words)``
    the ranges of their texts, as arrays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = W.texts(batch.column(2))
            for first, last, raw, starts in W.joined(parts):
                begin, _, hashes = W.words(raw)
                heads = np.searchsorted(begin, starts)
                found = [cut(h) for h in np.split(hashes, heads[1:])]
                sizes = [len(f[0]) for f in found]
                at = pa.array(np.repeat(np.arange(first, last), sizes))
                keys, froms, counts = (np.concatenate([f[i] for f in found]) for i in range(3))
                a, b = extent(froms, counts, np.repeat(np.diff(heads, append=len(hashes)), sizes))
                head = np.repeat(heads, sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(keys.astype(np.uint64).view(np.int64)),
                     *[pa.array(c, pa.int32()) for c in (a, b - a, froms - a)],
                     *map(pa.array, _names(hashes, head + a, head + b, froms - a))],
                    names=["id", "row", "key", "from", "n", "anchor", "p1", "p2"])

    return rows.where("id is not null").mapInArrow(run, "id long, row long, key long, from int, n int, anchor int, p1 long, p2 long")


def texts_of(found: DataFrame, stages: Stages) -> DataFrame:
    """Different texts of places: (p1, p2, key, lo, hi, id, row, from, n, anchor), the last five those of one place."""
    firsts = [F.first(c).alias(c) for c in ("key", "id", "row", "from", "n", "anchor")]
    return stages.save(found.groupBy("p1", "p2").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), *firsts), "texts")


def with_words(texts: DataFrame, rows: DataFrame, stages: Stages, times: int = 1) -> tuple[DataFrame, DataFrame]:
    """(p1, p2, key, lo, hi, anchor, words) of texts that share their key with another text, cold and hot ones apart.

    Every such text takes its words from one document.  Keys of one document, and keys that have one text
    only, need no words.  A text comes repeatedly where its document has equal rows.  A key is hot beyond ``times * HOT`` texts.
    """
    keys = texts.groupBy("key").agg(F.min("lo").alias("least"), F.max("hi").alias("most"), F.count("*").alias("many"))
    keys = stages.save(keys.where("least < most and many > 1").select("key", (F.col("many") > times * HOT).alias("hot")), "shared")
    inner = ("p1", "p2", "key", "lo", "hi", "anchor", "hot", "from", "n")
    lists = meeting(texts, keys, "key", stages).groupBy(F.col("id").alias("i"), F.col("row").alias("r")).agg(F.collect_list(F.struct(*inner)).alias("texts"))
    lists = stages.save(lists, "lists")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, lists = W.texts(batch.column(0)), batch.column(1)
            for first, last, _, _ in W.joined(parts):
                some = lists.slice(first, last - first)
                fields = some.flatten().flatten()
                froms, sizes = fields[7].to_pylist(), fields[8].to_pylist()
                words, at = [], 0
                for text, k in zip(parts[first:last], some.value_lengths().to_pylist()):
                    ws = text.split()
                    words += [b" ".join(ws[a : a + n]) for a, n in zip(froms[at : at + k], sizes[at : at + k])]
                    at += k
                yield pa.RecordBatch.from_arrays([*fields[:7], pa.array(words, pa.binary()).cast(pa.string())], names=[*inner[:7], "words"])

    worded = rows.join(lists, (F.col("id") == F.col("i")) & (F.col("row") == F.col("r"))).select("text", "texts")
    worded = worded.mapInArrow(run, "p1 long, p2 long, key long, lo long, hi long, anchor int, hot boolean, words string")
    # Texts of one document overlap and lie side by side: this codec stores most words once.
    worded = stages.save(worded, "words", compression="zstd")
    stages.drop("lists", "shared", "bloom")
    return worded.where("not hot"), worded.where("hot")


def groups(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[tuple]]:
    """Rows of equal first column, each of its texts (columns two and three) once; they arrive in this order."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(columns)]):
            if held and held[0][0] != row[0]:
                yield held
                held = []
            if not held or held[-1][1:3] != row[1:3]:
                held.append(row)
    if held:
        yield held


def hot_windows(hot: DataFrame, size: int, stages: Stages) -> DataFrame:
    """(p1, p2, at, first, last): per window of a hot text, its least and greatest document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(W.texts(batch.column(4))):
                _, _, hashes = W.words(text)
                one, two = W.windows(hashes, size), W.windows(W.mix(hashes ^ np.uint64(0xA5A5A5A5)), size)
                at = pa.array(np.full(len(one), k))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).take(at) for i in range(4)], pa.array(np.arange(len(one))),
                     pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
                    names=["p1", "p2", "lo", "hi", "at", "w1", "w2"])

    every = hot.select("p1", "p2", "lo", "hi", "words").mapInArrow(run, "p1 long, p2 long, lo long, hi long, at long, w1 long, w2 long")
    every = stages.save(every, "hot_windows")
    firsts = stages.save(every.groupBy("w1", "w2").agg(F.min("lo").alias("first"), F.max("hi").alias("last")).where("first < last"), "hot_firsts")
    return every.join(firsts, ["w1", "w2"]).select("p1", "p2", "lo", "hi", "at", "first", "last")
