"""Embedding near-dedup: sign hashing in several tables, exact cosines, components.

Method: random hyperplanes give every vector a code per table; vectors with equal label
and code meet in a bucket, where the cosine of every pair is computed in double
precision.  Links are counted and spanning links of each bucket go to the components.

* Equal vectors of a label are one class with a multiplicity (partial aggregate), so a
  vector that a third of all rows hold is one row.
* The bits of a code grow with the rows (``log2`` of the classes and two more), so chance
  meetings stay a constant number a vector.  The number of tables follows from the bits:
  the chance to miss a pair at the threshold is at most ``MISS``.
* A pair counts in the first table in which its codes agree: rows carry their codes.
* A bucket of more than ``BLOCK`` classes is split: members fall into chunks by hash, and each
  pair of chunks is its own group, so no task holds a bucket that grows with the data.
  Nothing lists pairs: a block emits a count per member and at most one link per member.

Null, zero, non-finite vectors, vectors with such a component, and null labels link with
nothing.  A null id is a row without a component (null), kept.  Vectors of different
length never link.  Repeated rows are separate vectors that link with each other;
extra columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzegate.llm.common import Stages
from bronzegate.llm.components import connected_components

COSINE = 0.98
MISS = 1e-7
BLOCK = 512
_SEED = 29


def tables_for(bits: int, cosine: float, miss: float = MISS) -> int:
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return math.ceil(math.log(miss) / math.log(1 - agree))


def _codes(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            out = []
            for v in batch.column(1).to_numpy(zero_copy_only=False):
                if len(v) not in planes:
                    planes[len(v)] = np.random.default_rng(_SEED + len(v)).standard_normal((tables, bits, len(v)))
                signs = np.einsum("tbd,d->tb", planes[len(v)], v.astype(float)) >= 0
                out.append((signs * weights).sum(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=["cls", "codes"])

    return run


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Spanning links of a boolean adjacency matrix."""
    n, seen, out = len(linked), np.zeros(len(linked), bool), []
    for root in range(n):
        if seen[root]:
            continue
        seen[root] = True
        front = [root]
        while front:
            x = front.pop()
            for y in np.flatnonzero(linked[x] & ~seen).tolist():
                seen[y] = True
                out.append((x, y))
                front.append(y)
    return out


def _compare(cosine: float):
    """Groups arrive whole and in order: (group, table, side, cls, n, codes, vector)."""

    def block(rows: list[tuple]) -> Iterator[tuple]:
        table = rows[0][1]
        by_length: dict[int, list[tuple]] = {}
        for r in rows:
            by_length.setdefault(len(r[6]), []).append(r)
        for part in by_length.values():
            if len(part) < 2:
                continue
            side = np.array([r[2] for r in part])
            codes = np.stack([r[5] for r in part])
            v = np.stack([r[6] for r in part]).astype(float)
            norm = np.sqrt((v * v).sum(1))
            many = np.array([r[4] for r in part])
            linked = np.zeros((len(part), len(part)), bool)
            first = linked.copy()
            for i in range(len(part)):  # a row at a time: memory follows the block
                cos = (v * v[i]).sum(1) / (norm * norm[i])
                linked[i] = cos >= cosine
                agree = codes[:, :table] == codes[i, :table]
                first[i] = ~agree.any(1)
                if (side != 0).any():
                    linked[i] &= side != side[i]  # other pairs of the chunk meet elsewhere
            np.fill_diagonal(linked, False)
            linked &= linked.T
            counts = ((linked & first) * many).sum(1)
            for i in np.flatnonzero(counts).tolist():
                yield part[i][3], None, int(counts[i])
            for a, b in _forest(linked):
                yield part[a][3], part[b][3], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            arrays = [batch.column(i).to_numpy(zero_copy_only=False) for i in (5, 6)]
            found = []
            for row in zip(*columns, *arrays):
                if held and held[0][0] != row[0]:
                    found.extend(block(held))
                    held = []
                held.append(row)
            if found:
                yield _links(found)
        if held:
            found = list(block(held))
            if found:
                yield _links(found)

    return run


def _links(found: list[tuple]) -> pa.RecordBatch:
    a, b, n = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())], names=["a", "b", "n"])


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 cosine: float = COSINE) -> DataFrame:
    """(id, n_links, component_id, kept) per input row."""
    spark = vectors.sparkSession
    stages = Stages(spark, "embedding_dedup")
    plain = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v"), F.col(label_col).alias("label"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("v", lambda x: x == 0)
    fine = F.col("id").isNotNull() & F.col("v").isNotNull() & F.col("label").isNotNull() & ~bad & ~zero
    # A random 128-bit name of (label, vector); -0.0 equals 0.0.
    same = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0).cast("float")).otherwise(x))
    name = F.unhex(F.md5(F.concat_ws(",", F.col("label").cast("string"), F.col("v").cast("string"))))
    rows = plain.withColumn("v", F.when(fine, same)).select("id", "label", "v", F.when(fine, name).alias("cls"))
    classes = rows.where("cls is not null").groupBy("cls").agg(
        F.min("id").alias("low"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = stages.save(classes, "classes")
    total = classes.count()
    bits = min(40, max(10, math.ceil(math.log2(total + 1)) + 2))
    tables = tables_for(bits, cosine)
    codes = stages.save(classes.select("cls", "v").mapInArrow(_codes(bits, tables), "cls binary, codes array<long>"), "codes")
    keyed = codes.select("cls", F.posexplode("codes").alias("table", "code")).join(classes.select("cls", "label"), "cls")
    keyed = stages.save(keyed.withColumn("key", F.xxhash64("label", "table", "code")).select("key", "table", "cls"), "keyed")
    crowded = stages.save(keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "crowded")
    entries = keyed.join(crowded, "key").withColumn("chunks", F.ceil(F.col("size") / BLOCK).cast("int"))
    mine = F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int")
    entries = entries.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    pair = F.struct(F.least("mine", "other"), F.greatest("mine", "other"))
    entries = entries.select(
        "cls", "table", F.xxhash64("key", pair).alias("group"),
        F.when(F.col("mine") == F.col("other"), 0).otherwise(F.when(F.col("mine") < F.col("other"), 1).otherwise(2)).alias("side"))
    full = entries.join(classes.select("cls", "n", "v"), "cls").join(codes, "cls").select("group", "table", "side", "cls", "n", "codes", "v")
    ordered = full.repartition("group").sortWithinPartitions("group")
    found = stages.save(ordered.mapInArrow(_compare(cosine), "a binary, b binary, n long"), "found")
    member = connected_components(found.where("b is not null").select("a", "b"), stages)
    counts = stages.save(found.where("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("links")), "counts")
    grouped = stages.save(
        classes.select("cls", "low", "n").join(member.withColumnRenamed("node", "cls"), "cls", "left").join(counts, "cls", "left")
        .select("cls", "low", F.coalesce("comp", "cls").alias("comp"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")), "grouped")
    lowest = stages.save(grouped.groupBy("comp").agg(F.min("low").alias("component")), "lowest")
    named = stages.save(grouped.join(lowest, "comp").select("cls", "component", "links"), "named")
    out = rows.select("id", "cls").join(named, "cls", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def digest(vectors: DataFrame) -> DataFrame:
    return link_vectors(vectors.select("vec_id", "embedding", "label"))
