"""Near-duplicate documents by min-max hashing of word shingles.

Method: of every permutation both the least and the greatest value are kept, so
half the permutations fill a signature of the same length.  Signatures are cut into
bands; equal bands propose pairs, and every proposed pair is confirmed on the
full shingle sets before it links.

* Documents with the same shingle set (exact copies among them) are one class
  from the start, found by a partial aggregate on a 128-bit digest of the set.
* A bucket (equal band) of at most ``SMALL`` classes compares all its classes.  A larger
  bucket compares all its classes with a few pivots; the pivot of the first round
  is the class that shares the most buckets, the likely original of a group of
  edited copies.  Pivots have then met every class of the bucket and leave it; the
  buckets that still hold several components go to the next round with ``GROWTH``
  times the pivots.  As soon as what is open is at most ``SMALL`` pairs per entry, every
  class outside the largest component of a bucket meets all others there, and that is the end.  So every proposed pair is either confirmed
  or refused on the full sets, or already known to be in one component, and a
  group of copies costs a multiple of its size, not its square.
* Sets are 64-bit hashes of the shingles; they move only for proposed pairs, and only if
  the size of their difference allows the similarity: sizes and the parities of the elements
  over 512 places are lower bounds of it, so this loses no link.

With ``similarity`` s, ``rows`` r and ``bands`` b a pair at s is missed with probability
``(1 - s**r) ** b``: 1.1e-5 at 0.85 with 10 x 52, 3.4e-5 at 0.8 with 8 x 56.  Long bands keep texts
that only share a passage apart (at 0.5 one band in 1000 agrees).

Words: A-Z lower-cased, parted by ASCII white space.  Set: distinct shingles of
``k`` words; with fewer words the whole sequence is the one shingle; without words
the set is empty and links with nothing.

Defined cases: null text is empty; a null id forms no component (null) and is
kept; rows with equal ids are one document with several texts, each row gets its
own result; equal sets link, ties go to the smaller id; other columns are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzegate.llm import words as W
from bronzegate.llm.bloom import having, meeting
from bronzegate.llm.common import Stages, small
from bronzegate.llm.components import connected_components

BANDS, ROWS = 56, 8
SMALL = 64
GROWTH = 32
WORDS = 8
BATCH = 1000  # texts handed to Python at a time
_SEED = 7


def _shingles(h: np.ndarray, k: int) -> np.ndarray:
    """The set of one document, sorted; ``h`` are its word hashes."""
    if len(h) == 0:
        return h
    # Fewer than k words: the whole sequence, told apart from shingles by its length.
    return np.unique(W.windows(h, k)) if len(h) >= k else W.windows(h, len(h)) ^ np.uint64(len(h))


def _sets(raw: bytes, starts: np.ndarray, k: int) -> list[np.ndarray]:
    begin, _, hashes = W.words(raw)
    cut = np.searchsorted(begin, starts)
    return [_shingles(x, k) for x in np.split(hashes, cut[1:])]


def _digest(sets: list[np.ndarray], at: np.ndarray, flat: np.ndarray) -> list[bytes]:
    """128 bits of each set: two sums of differently mixed elements."""
    sums = [np.add.reduceat(W.mix(flat ^ np.uint64(c)), at) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
    both = np.ascontiguousarray(np.stack(sums, 1))
    return [x.tobytes() for x in both]


def _sketch(at: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Parities of the elements of each set over ``64 * WORDS`` places, as rows of longs."""
    places = 64 * WORDS
    place = (W.mix(flat ^ np.uint64(0x165667B19E3779F9)) >> np.uint64(32)).astype(np.int64) % places
    of = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(flat))))
    odd = np.bincount(of * places + place, minlength=len(at) * places) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(at), places), axis=1).view(np.int64)


def _signatures(k: int, bands: int, rows: int):
    rng = np.random.default_rng(_SEED)
    perms = (bands * rows + 1) // 2
    mul = rng.integers(1, 2**63, perms, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    xor = rng.integers(0, 2**63, perms, dtype=np.uint64)
    band_mul = rng.integers(1, 2**63, (bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, parts = batch.column(0), batch.column(2), [t.lower() for t in W.texts(batch.column(1))]
            for first, last, raw, starts in W.joined(parts):
                sets = _sets(raw, starts, k)
                n = np.fromiter(map(len, sets), np.int64, len(sets))
                full = np.flatnonzero(n)
                keys, digests, sketches = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    at = np.cumsum(n[full]) - n[full]
                    values = np.empty((2 * perms, len(full)), np.uint64)
                    for j in range(perms):
                        v = (flat ^ xor[j]) * mul[j]
                        values[2 * j] = np.minimum.reduceat(v, at)
                        values[2 * j + 1] = np.maximum.reduceat(v, at)
                    # Least and greatest of a permutation go to different bands.
                    order = np.concatenate([np.arange(0, 2 * perms, 2), np.arange(1, 2 * perms, 2)])
                    table = values[order][: bands * rows].reshape(bands, rows, len(full))
                    key = (table * band_mul[:, :, None]).sum(1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)[:, None]
                    key = W.mix(key).view(np.int64)
                    for i, d, x, y in zip(full, _digest(sets, at, flat), key.T, _sketch(at, flat)):
                        keys[i], digests[i], sketches[i] = x, d, y
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, last - first), hashes.slice(first, last - first), pa.array(n), pa.array(digests, pa.binary()),
                     pa.array(sketches, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))],
                    names=["id", "row", "n", "cls", "sketch", "bands"],
                )

    return run


def _set_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [t.lower() for t in W.texts(batch.column(0))]
            for _, _, raw, starts in W.joined(parts):
                sets = [s for s in _sets(raw, starts, k) if len(s)]
                if sets:
                    flat = np.concatenate(sets)
                    n = np.fromiter(map(len, sets), np.int64, len(sets))
                    digests = _digest(sets, np.cumsum(n) - n, flat)
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(flat.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), lists], names=["cls", "items"])

    return run


def _confirm(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The ``pairs`` whose sets, of ``a`` and ``b``, reach the similarity."""
    side = lambda c: sets.select(F.col("cls").alias(c), F.col("items").alias(f"{c}_items"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    common = F.size(F.array_intersect("a_items", "b_items")).cast("long")
    total = F.size("a_items").cast("long") + F.size("b_items") - common
    return both.where(common * den >= total * num)


def _moved(df: DataFrame, step: DataFrame) -> DataFrame:
    """``df`` with its components replaced by those that they are joined to."""
    step = step.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    return df.join(step, "comp", "left").withColumn("comp", F.coalesce("to", "comp")).drop("to")


def _link(entries: DataFrame, pivot: DataFrame, once: Column, sets: DataFrame, member: DataFrame | None,
          num: int, den: int, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Components after the pivots met their buckets: of the classes, and of the components before."""
    alike = F.least("n", "a_n") * den >= F.greatest("n", "a_n") * num
    # Sets whose parities differ in d places differ in at least d elements.
    apart = sum(F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("a_sketch")[i])) for i in range(WORDS)).cast("long")
    alike = alike & (apart * (num + den) <= (F.col("n") + F.col("a_n")) * (den - num))
    met = entries.join(pivot, (F.col("key") == F.col("bucket")) & (F.col("a_comp") != F.col("comp")) & once & alike)
    pairs = met.select("a", F.col("cls").alias("b"), "a_comp", F.col("comp").alias("b_comp")).distinct()
    new = _confirm(pairs, sets, num, den).select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b"))
    step = connected_components(new, stages)
    if member is None:
        return step, step
    more = step.join(member, "node", "left_anti")  # classes that were alone
    return stages.save(_moved(member, step).select("node", "comp").unionByName(more), "member"), step


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    num: int = 4, den: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, row, n_shingles, component_id, kept, grp) per input row; similarity is ``num/den``.

    ``row`` is the hash of the text, ``grp`` names the group itself: two groups may have the same smallest id.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "minhash")
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("body"))
    signed = stages.save(
        plain.withColumn("row", F.xxhash64(F.coalesce("body", F.lit("")))).mapInArrow(
            _signatures(k, bands, rows), "id long, row long, n long, cls binary, sketch array<long>, bands array<long>"), "signatures", batch=BATCH)
    classes = stages.save(
        signed.where("cls is not null and id is not null").groupBy("cls")
        .agg(F.min("id").alias("low"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")), "classes")
    keyed = classes.select("cls", "n", "sketch", F.explode("bands").alias("key"))
    buckets = stages.save(keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    entries = stages.save(meeting(keyed, buckets, "key", stages), "crowded")
    score = stages.save(entries.groupBy("cls").agg(F.sum("size").alias("score")), "scores")
    entries = stages.save(entries.join(score, "cls").withColumn("comp", F.col("cls")), "entries")
    stages.drop("buckets", "crowded", "bloom")

    # Sets of the classes that share a bucket, from one text of each.
    wanted = stages.save(score.join(classes, "cls").select(F.col("low").alias("id")).distinct(), "wanted")
    chosen = having(plain, wanted, "id", stages).select("body")
    sets = chosen.mapInArrow(_set_rows(k), "cls binary, items array<long>")
    sets = stages.save(sets.groupBy("cls").agg(F.first("items").alias("items")), "sets", batch=BATCH)

    stages.drop("scores")

    rows_in, member, pivots_per_bucket = entries.count(), None, 1
    while not entries.isEmpty():
        # Every class of a small bucket is a pivot; of a large one, one per salt.
        salt = F.when(F.col("size") <= SMALL, F.xxhash64("cls")).otherwise(F.pmod(F.xxhash64("cls"), F.lit(pivots_per_bucket)))
        pivot = stages.save(
            entries.groupBy("key", salt.alias("salt")).agg(F.max(F.struct("score", "cls", "n", "comp", "sketch")).alias("p"))
            .select(F.col("key").alias("bucket"), F.col("p.cls").alias("a"), F.col("p.n").alias("a_n"), F.col("p.comp").alias("a_comp"), F.col("p.sketch").alias("a_sketch")), "pivots")
        once = F.when(F.col("size") > SMALL, F.col("a") != F.col("cls")).otherwise(F.col("a") < F.col("cls"))
        member, step = _link(entries, pivot, once, sets, member, num, den, stages)
        # What is left: large buckets that hold several components, without the pivots.
        left = entries.where(F.col("size") > SMALL).join(pivot.select(F.col("bucket").alias("key"), F.col("a").alias("cls")), ["key", "cls"], "left_anti")
        left = stages.save(_moved(left, step), "left")
        shares = left.groupBy("key", "comp").agg(F.count("*").alias("rows")).groupBy("key").agg(
            F.sum("rows").alias("total"), F.max(F.struct("rows", "comp")).alias("top")).where(F.col("total") > F.col("top.rows"))
        mixed = stages.save(shares.select("key", F.col("top.comp").alias("major"), (F.col("total") * (F.col("total") - F.col("top.rows"))).alias("pairs")), "mixed")
        entries = stages.save(left.join(mixed.select("key", "major"), "key"), "entries")
        stages.drop("pivots", "left", "links", "parents")
        stages.drop("entries", "member", "members", older=True)
        if (mixed.agg(F.sum("pairs")).first()[0] or 0) <= SMALL * rows_in:
            # As cheap as small buckets: each class outside a bucket's largest component meets all others.
            pivot = entries.where(F.col("comp") != F.col("major")).select(
                F.col("key").alias("bucket"), F.col("cls").alias("a"), F.col("n").alias("a_n"), F.col("comp").alias("a_comp"), F.col("sketch").alias("a_sketch"))
            member, _ = _link(entries, pivot, (F.col("comp") == F.col("major")) | (F.col("a") < F.col("cls")), sets, member, num, den, stages)
            break
        entries = entries.drop("major")
        pivots_per_bucket *= GROWTH

    if member is None:
        member = entries.select(F.col("cls").alias("node"), F.col("cls").alias("comp"))
    grouped = stages.save(classes.select("cls", "low").join(member.withColumnRenamed("node", "cls"), "cls", "left")
                          .select("cls", "low", F.coalesce("comp", "cls").alias("comp")), "grouped")
    lowest = stages.save(grouped.groupBy("comp").agg(F.min("low").alias("component")), "lowest")
    named = stages.save(grouped.join(lowest, "comp").select("cls", "component", F.col("comp").alias("grp")), "named")
    return stages.finish(signed.select("id", "row", "n", "cls").join(named, "cls", "left").select(
        F.col("id").alias(id_col), "row", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"), "grp"))


def digest(docs: DataFrame) -> DataFrame:
    """Contract: three-word shingles, 100 * intersection >= 85 * union."""
    return near_duplicates(docs, k=3, num=85, den=100, bands=52, rows=10).drop("row", "grp")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group stays (five words, 0.8): the one with the smallest id.

    A document is its id and text.  Of several texts of a group under that id the one with the least hash
    stays; of rows with equal id and text any one stays, whatever their other columns.
    """
    found = near_duplicates(docs)
    least = found.where("kept and grp is not null").groupBy("grp").agg(F.min("row").alias("least"))
    judged = found.join(least, "grp", "left")
    out = judged.where("not kept or row <> least").select(F.col("doc_id").alias("__mh_id"), F.col("row").alias("__mh_row")).distinct()
    row = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    mine = lambda row: docs["doc_id"].eqNullSafe(F.col("__mh_id")) & (row == F.col("__mh_row"))
    kept = docs.join(small(out), mine(row), "left_anti")
    again = found.groupBy(F.col("doc_id").alias("__mh_id"), F.col("row").alias("__mh_row")).agg(F.count("*").alias("n")).where("n > 1").select("__mh_id", "__mh_row")
    if again.isEmpty():
        return kept
    again = small(again)
    return kept.join(again, mine(row), "left_anti").unionByName(kept.join(again, mine(row), "left_semi").dropDuplicates(["doc_id", "text"]))
