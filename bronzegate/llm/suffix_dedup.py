"""Suffix-array dedup: passages of ``SIZE`` or more words that several documents hold.

Method: a sparse suffix array.  Only suffixes at content-selected places are kept, the
minimisers of ``M`` words in every window of ``SIZE`` words, so every such window of two
documents has a kept suffix at the same place in both.  Suffixes with the same first
``M`` words are sorted together and neighbours compared; a match is then extended left.

* A suffix travels with ``SIZE`` words to the right and ``SIZE - M`` to the left: any window that
  holds the place lies within.  Places whose minimiser is in one document only stay.
* Of a suffix the sorted neighbours have the longest match to the right, and the
  neighbours in the order of the reversed left sides the longest to the left.  If the
  two together are shorter than ``SIZE`` nothing matches; if both neighbours match over ``SIZE``
  words their union is the whole answer; else (rare) the windows are compared.
* Equal surroundings are merged first (partial aggregate, by name) and wholly covered; a place shared by more than
  ``GATHERED * HOT`` different surroundings is resolved window by window under 128-bit hashes.

Result: one row per maximal run of words of a document that lies in windows which another
document holds too: (doc id, start, n_words, other), ``other`` being one such document.
Clean documents have no row.

Defined cases: null or blank text has no words; a null id is not compared; rows with equal
ids are one document with several texts; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzegate.llm import passages as P
from bronzegate.llm.common import Stages

SIZE, M = 50, 8
#: Sorting costs little more a text in larger buckets, so they are gathered up to this many times ``passages.HOT`` texts.
GATHERED = 16


def _selected(size: int, m: int):
    def cut(hashes: np.ndarray):
        at, keys = P.minimisers(hashes, size, m)
        at = np.unique(at)
        return keys[at], at, np.ones(len(at), np.int64)

    return cut


def _common(a: list[str], b: list[str]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _nearest(sides: list[list[str]]) -> list[tuple[int, int]]:
    """Per row: (length, row) of the longest common beginning with another, by sorted neighbours."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [(-1, -1)] * len(sides)
    for i, j in zip(order, order[1:]):
        n = _common(sides[i], sides[j])
        out[i], out[j] = max(out[i], (n, j)), max(out[j], (n, i))
    return out


def _matches(size: int):
    def covered(rows: list[tuple]) -> Iterator[tuple]:
        """(row, from, to, other) in words of the row's text."""
        texts = [r[6].split(" ") for r in rows]
        left = [t[: r[5]][::-1] for r, t in zip(rows, texts)]
        right = [t[r[5] :] for r, t in zip(rows, texts)]
        by_right, by_left = _nearest(right), _nearest(left)
        windows: dict[tuple, tuple[int, int]] = {}
        for k, (_, _, _, lo, hi, anchor, _) in enumerate(rows):
            if lo < hi:  # the whole surroundings are in two documents: all covered
                continue
            (r, i), (n, j) = by_right[k], by_left[k]
            if i < 0 or r + n < size:
                continue
            strange = lambda x: rows[x][3] != lo or rows[x][4] != lo  # noqa: B023, E731
            if strange(i) and strange(j) and _common(left[k], left[i]) + r >= size and _common(right[k], right[j]) + n >= size:
                other = rows[i][3] if rows[i][3] != lo else rows[i][4]
                yield k, anchor - n, anchor + r, lo, other
                continue
            if not windows:
                for t, row in zip(texts, rows):
                    for s in range(len(t) - size + 1):
                        key = tuple(t[s : s + size])
                        a, b = windows.get(key, (row[3], row[4]))
                        windows[key] = min(a, row[3]), max(b, row[4])
            # Windows side by side that the same document holds are one span.
            at, to, held = 0, -1, None
            for s in range(len(texts[k]) - size + 1):
                a, b = windows[tuple(texts[k][s : s + size])]
                other = (a if a != lo else b) if a < b else None
                if other != held:
                    if held is not None:
                        yield k, at, to, lo, held
                    at, held = s, other
                to = s + size
            if held is not None:
                yield k, at, to, lo, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in P.groups(batches, 7):
            found = list(covered(rows))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[k][1] for k, *_ in found], pa.int64()), pa.array([rows[k][2] for k, *_ in found], pa.int64()),
                     *[pa.array([f[i] for f in found], pa.int64()) for i in (1, 2, 3, 4)]],
                    names=["p1", "p2", "a", "b", "one", "two"])

    return run


def _spans(windows: DataFrame, size: int) -> DataFrame:
    """(p1, p2, a, b, one, two): the windows of a text that lie side by side and have the same two documents are one span."""
    some = windows.groupBy("p1", "p2").agg(F.array_sort(F.collect_set(F.struct("first", "last", "at"))).alias("w"))

    def ends(step: int) -> Column:
        """The windows without one like them ``step`` further on; starts and ends come in the same order."""
        beside = lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last"), (x["at"] + step).alias("at"))
        return F.filter("w", lambda x: ~F.array_contains("w", beside(x)))

    runs = some.select("p1", "p2", F.inline(F.arrays_zip(ends(-1).alias("start"), ends(1).alias("end"))))
    return runs.select("p1", "p2", F.col("start.at").alias("a"), (F.col("end.at") + size).alias("b"),
                       F.col("start.first").alias("one"), F.col("start.last").alias("two"))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            at, to, other = -1, -1, None
            for s in spans:
                if s["a"] > to:
                    if other is not None:
                        out.append((doc, at, to - at, other))
                    at, to, other = s["a"], s["b"], s["other"]
                to, other = max(to, s["b"]), min(other, s["other"])
            out.append((doc, at, to - at, other))
        columns = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "start", "n_words", "other"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, m: int = M) -> DataFrame:
    """(id, start, n_words, other_<id>) per repeated run of words; rows that share a text share spans."""
    stages = Stages(docs.sparkSession, "suffix_dedup")
    rows = P.plain_rows(docs, id_col, text_col)
    reach = lambda s, c, n: (np.maximum(0, s - (size - m)), np.minimum(n, s + size))
    found = stages.save(P.places(rows, _selected(size, m), reach), "places")
    texts = P.texts_of(found, stages)
    cold, hot = P.with_words(texts, rows, stages, GATHERED)
    order = ["key", "p1", "p2"]
    ordered = cold.select(*order, "lo", "hi", "anchor", "words").repartition("key").sortWithinPartitions(*order)
    spans = "p1 long, p2 long, a long, b long, one long, two long"
    whole = texts.where("lo < hi").selectExpr("p1", "p2", "0L AS a", "CAST(n AS BIGINT) AS b", "lo AS one", "hi AS two")
    late = _spans(P.hot_windows(hot, size, stages), size)
    matches = stages.save(ordered.mapInArrow(_matches(size), spans).unionByName(late).unionByName(whole), "matches")
    stages.drop("words", "texts", "hot_windows", "hot_firsts")
    member = found.select("id", "row", "from", "p1", "p2").join(matches, ["p1", "p2"])
    other = F.when(F.col("one") != F.col("id"), F.col("one")).otherwise(F.col("two"))
    spans = member.select("id", "row", F.struct((F.col("from") + F.col("a")).alias("a"), (F.col("from") + F.col("b")).alias("b"), other.alias("other")).alias("s"))
    spans = spans.groupBy("id", "row").agg(F.array_sort(F.collect_set("s")).alias("spans")).select("id", "spans")
    merged = spans.mapInArrow(_merge, "id long, start long, n_words long, other long")
    return merged.select(F.col("id").alias(id_col), "start", "n_words", F.col("other").alias(f"other_{id_col}"))


def digest(docs: DataFrame) -> DataFrame:
    return repeated_passages(docs.select("doc_id", "text"))
