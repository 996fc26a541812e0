"""Substring dedup: words in windows that an earlier document holds too are removed.

Method: super-k-mers.  Every window of ``SIZE`` words has a minimiser, its least hash of ``M``
consecutive words; consecutive windows with the same one travel as one packed string
to its bucket, where sorting brings equal windows together and gives each its first
document, exactly (strings are compared, not hashes).

* Super-k-mers whose minimiser occurs in one document only stay behind (see ``passages``).
* Equal strings are merged before the bucket (partial aggregate, by name), so a group of copies
  is one row a super-k-mer.  A bucket that still holds more than ``HOT`` different strings
  is not gathered: its windows are counted one by one under a 128-bit hash.

Words are parted by ASCII white space and unchanged; kept words are joined by one space.
Defined cases: null or blank text has no words; a null id is not compared and loses
nothing; rows with equal ids are one document with several texts (windows of the
same id never remove each other); an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzegate.llm import passages as P
from bronzegate.llm import words as W
from bronzegate.llm.common import Stages

SIZE, M = 50, 10


def _super_kmers(size: int, m: int):
    def cut(hashes: np.ndarray):
        at, keys = P.minimisers(hashes, size, m)
        if not len(at):
            return np.zeros(0, np.uint64), at, at
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        return keys[at[starts]], starts, np.diff(np.append(starts, len(at)))

    return cut


def _earlier(size: int):
    """Of a bucket's strings: the windows whose first document is before the string's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in P.groups(batches, 5):
            if len(rows) < 2:
                continue
            windows = []
            for k, (_, _, _, lo, text) in enumerate(rows):
                ws = text.split(" ")
                windows += [(" ".join(ws[i : i + size]), lo, k, i) for i in range(len(ws) - size + 1)]
            windows.sort()
            found: dict[int, list[int]] = {}
            same, first = None, 0
            for text, lo, k, i in windows:
                if text != same:
                    same, first = text, lo
                elif first < lo:
                    found.setdefault(k, []).append(i)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[k][1] for k in found], pa.int64()), pa.array([rows[k][2] for k in found], pa.int64()),
                     pa.array(list(found.values()), pa.list_(pa.int64()))],
                    names=["p1", "p2", "earlier"])

    return run


def _drop(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, spans in zip(batch.column(0).to_pylist(), W.texts(batch.column(1)), batch.column(2).to_pylist()):
                ws = text.split()
                gone = np.zeros(len(ws) + 1, np.int64)
                for s in spans or ():
                    gone[s["a"]] += 1
                    gone[s["b"]] -= 1
                stays = np.cumsum(gone)[:-1] == 0
                kept = [w for w, k in zip(ws, stays.tolist()) if k] if spans else ws
                out.append((doc, len(ws), len(ws) - len(kept), b" ".join(kept).decode()))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])], names=["id", "n_words", "n_removed", "kept_text"])

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, m: int = M) -> DataFrame:
    """(id, n_words, n_removed, kept_text) per input row."""
    stages = Stages(docs.sparkSession, "substring_dedup")
    rows = P.plain_rows(docs, id_col, text_col)
    found = stages.save(P.places(rows, _super_kmers(size, m), lambda s, c, n: (s, s + c + size - 1)), "places")
    texts = P.texts_of(found, stages)
    cold, hot = P.with_words(texts, rows, stages)
    order = ["key", "p1", "p2"]
    ordered = cold.select(*order, "lo", "words").repartition("key").sortWithinPartitions(*order)
    earlier = ordered.mapInArrow(_earlier(size), "p1 long, p2 long, earlier array<long>")
    late = P.hot_windows(hot, size, stages).where("first < lo").groupBy("p1", "p2").agg(F.collect_set("at").alias("earlier"))
    earlier = stages.save(earlier.unionByName(late), "earlier")
    stages.drop("words", "hot_windows", "hot_firsts")
    judged = texts.select("p1", "p2", "lo", "hi").join(earlier, ["p1", "p2"], "left")
    judged = stages.save(judged.where("lo < hi or earlier is not null").drop("hi"), "judged")
    stages.drop("texts", "earlier")
    member = found.select("id", "row", "from", "n", "p1", "p2").join(judged, ["p1", "p2"])
    whole = F.array(F.struct(F.col("from").cast("long").alias("a"), (F.col("from") + F.col("n")).cast("long").alias("b")))
    parts = F.transform(F.coalesce("earlier", F.array().cast("array<bigint>")),
                        lambda i: F.struct((F.col("from") + i).alias("a"), (F.col("from") + i + size).alias("b")))
    spans = member.select("id", "row", F.explode(F.when(F.col("id") > F.col("lo"), whole).otherwise(parts)).alias("s"))
    spans = spans.groupBy(F.col("id").alias("i"), F.col("row").alias("r")).agg(F.collect_set("s").alias("spans"))
    spans = stages.save(spans, "spans")
    stages.drop("places", "judged")
    joined = rows.join(spans, (F.col("id") == F.col("i")) & (F.col("row") == F.col("r")), "left").select("id", "text", "spans")
    return joined.mapInArrow(_drop(size), "id long, n_words long, n_removed long, kept_text string").withColumnRenamed("id", id_col)


def digest(docs: DataFrame) -> DataFrame:
    return substring_dedup(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
