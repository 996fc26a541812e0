"""Packing: documents into token sequences, by column generation for cutting stock.

* Tokenising: one pass over the whole texts.  The tokenizer drops white space, so a
  word's ids do not depend on its neighbours; each worker keeps the ids of words
  it has met lately (at most twice ``CACHE`` of them).  Ids come from the tokenizer's own normaliser,
  pre-tokenizer and model; id 1 ends a document.
* Cutting: pieces of ``capacity`` ids, and what remains.  Pieces of one length under
  ``capacity / 32`` ids go in bundles, at most ``4 * GRID`` pieces that lose little to rounding.  An item is a bundle or one longer
  piece.  Its class is its length in units, rounded up, so there are ``capacity / GRID`` classes at any scale.
* Cutting stock over the histogram of classes (the only thing the driver sees): a linear
  program over patterns, solved by revised simplex; a knapsack by dynamic programming
  prices the next pattern; what rounding down leaves goes first-fit-decreasing.
* Pieces are ranked within their kind (a class, or a length of short ones); a rank gives the item, the
  pattern's copy and the slot.  Ranks come from counts by (kind, hash bucket) of about ``BUCKET_ROWS`` pieces, summed
  within blocks of buckets and over blocks, so a kind that holds a third of all pieces is never in one task.  Offsets are running sums per sequence.

Loss: half a unit of ``GRID`` per piece of ``capacity / 32`` ids or more and per short length, at most ``GAP`` of
all sequences above the program's bound, and a few sequences of the rounding.

Defined cases: null or empty text is the one id 1; a null id stays null; equal rows are
packed once each; an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import re
import string
import zlib
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bronzegate.llm import words as W
from bronzegate.llm.common import Stages

CAPACITY = 2048
GRID = 8
END = 1
CACHE = 600_000
BUCKET_ROWS = 2_000
#: Buckets whose counts are summed up together first.
BLOCK = 1024
#: The linear program ends this close (relative) to its lower bound.
GAP = 0.01


# Fixed value: the tokenizer file's own split pattern, for lower-case ASCII words.
_ASCII_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")

_ASCII_MARKS = string.punctuation.encode()
_ID = attrgetter("id")
_CONTROL = re.compile(rb"[\x00-\x20\x7f]")

# The same pattern for words of letters below U+0250, which are in composed form and have no
# lower case that depends on neighbours; words with other characters go through the tokenizer's own steps.
_LATIN = re.compile("[\x21-\x7e\xa1-\u024f]+")
_LATIN_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte that byte-level models use."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()


class _Recent(dict):
    """A bounded table that works out what it lacks; the half used longest ago is forgotten when it is full."""

    def __init__(self, work):
        self.work = work
        self.older: dict = {}

    def __missing__(self, key):
        out = self.older.get(key)
        if out is None:
            out = self.work(key)
        if len(self) >= CACHE:
            self.older = dict(self)
            self.clear()
        self[key] = out
        return out


class _Words:
    """Words to their ids as packed little-endian 32-bit integers.

    Words of ASCII and of Latin letters need no normaliser but ``lower``; letters alone are
    one part, the unit of the tokenizer's model, and so are the marks after them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.normalise = self.whole.normalizer.normalize_str
        self.split = self.whole.pre_tokenizer.pre_tokenize_str
        self.encode = self.whole.model.tokenize
        self.ids = _Recent(self.word)
        self.marks = _Recent(self.part)

    def part(self, part: str) -> bytes:
        return array("I", map(_ID, self.encode(part))).tobytes()

    def latin(self, part: str) -> bytes:
        """A part as written: its bytes get their stand-ins first."""
        return self.part(part if part.isascii() else part.encode().decode("latin-1").translate(_BYTE_LETTERS))

    def word(self, word: bytes) -> bytes:
        letters = word.rstrip(_ASCII_MARKS)
        if letters.isalpha():
            ids = self.part(letters.decode().lower())
            return ids + self.marks[word[len(letters) :].decode()] if len(letters) < len(word) else ids
        if b"<|" in word:  # a special token's string may be inside
            ids = self.whole.encode(word.decode(), add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        if word.isascii() and not _CONTROL.search(word):
            return b"".join(map(self.part, _ASCII_PARTS.findall(word.decode().lower())))
        text = word.decode()
        if _LATIN.fullmatch(text):
            text = text.lower()
            return self.latin(text) if text.isalpha() else b"".join(map(self.latin, _LATIN_PARTS.findall(text)))
        return b"".join([self.part(p) for p, _ in self.split(self.normalise(text))])


_tokenizers: dict[str, _Words] = {}


def _pieces(path: str, capacity: int, with_ids: bool):
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _tokenizers:
            _tokenizers[path] = _Words(path)
        ids_of = _tokenizers[path].ids
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), W.texts(batch.column(1))):
                packed = b"".join(map(ids_of.__getitem__, text.split())) + end
                n = len(packed) // 4
                for start in range(0, n, capacity):
                    part = packed[4 * start : 4 * (start + capacity)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), n, part if with_ids else None))
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return run


def _best_pattern(value: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Counts per size of the most valuable content of one sequence (unbounded knapsack)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        fit = int(np.searchsorted(sizes, c, "right"))
        if fit:
            total = value[:fit] + best[c - sizes[:fit]]
            k = int(total.argmax())
            if total[k] > best[c] + 1e-12:
                best[c], pick[c] = total[k], k
    out, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            out[pick[c]] += 1
            c -= sizes[pick[c]]
    return out


def cutting_stock(demand: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(copies, {size: count}) that use up ``demand`` exactly, in few sequences of ``capacity``."""
    sizes = np.array(sorted(s for s, n in demand.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    need = np.array([demand[s] for s in sizes.tolist()], float)
    m = len(sizes)
    alone = (capacity // sizes).astype(float)  # a basis: one size alone in each pattern
    columns, inverse = np.diag(alone), np.diag(1 / alone)
    for _ in range(20 * m):
        level = (inverse * need).sum(1)
        dual = inverse.sum(0)
        pattern = _best_pattern(dual, sizes, capacity)
        # Farley's bound: no packing takes fewer than value / price sequences.
        value, price = float((dual * need).sum()), float((dual * pattern).sum())
        if price <= 1 + 1e-9 or value - value / price < max(0.5, GAP * value):
            break
        change = (inverse * pattern).sum(1)
        ratio = np.where(change > 1e-9, level / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        columns[:, out] = pattern
        pivot = inverse[out] / change[out]
        inverse -= change[:, None] * pivot
        inverse[out] = pivot
    level = (inverse * need).sum(1)
    copies = np.floor(np.maximum(level, 0) + 1e-7).astype(np.int64)
    left = need.astype(np.int64) - (columns.astype(np.int64) * copies).sum(1)
    while (left < 0).any():  # only if rounding noise took one too many
        copies[int(np.argmax(columns[int(np.argmin(left))] * (copies > 0)))] -= 1
        left = need.astype(np.int64) - (columns.astype(np.int64) * copies).sum(1)
    used = [(int(c), {int(s): int(k) for s, k in zip(sizes, columns[:, j]) if k}) for j, c in enumerate(copies) if c]
    while left.any():
        room, content = capacity, {}
        for i in range(m - 1, -1, -1):
            k = min(int(left[i]), room // int(sizes[i]))
            if k:
                content[int(sizes[i])] = k
                room -= k * int(sizes[i])
        times = min(int(left[i]) // content[int(sizes[i])] for i in range(m) if int(sizes[i]) in content)
        for i in range(m):
            left[i] -= times * content.get(int(sizes[i]), 0)
        used.append((times, content))
    return used


def _places(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple]:
    """(class, first rank, end rank, per copy, first sequence, first slot) per pattern and class."""
    out, taken, first = [], {}, 0
    for copies, content in patterns:
        slot = 0
        for size in sorted(content, reverse=True):
            k, at = content[size], taken.get(size, 0)
            out.append((size, at, at + k * copies, k, first, slot))
            taken[size] = at + k * copies
            slot += k
        first += copies
    return out


def _bundle(length: int, grid: int, units: int) -> int:
    """Pieces of ``length`` ids in a bundle: as many as fill sequences of ``units`` alone best, then lose least to rounding."""
    size = lambda g: -(-g * length // grid)
    return max(range(1, 4 * grid + 1), key=lambda g: (g * (units // size(g)), g * length / size(g), -g))


def _items(kinds: dict[int, int], grid: int, units: int) -> tuple[dict[int, int], list[tuple]]:
    """Demand by class, and (kind, first rank, end rank, pieces an item, class, first item) of every kind.

    A kind above 0 is a class of single pieces, one below 0 the length of short pieces.
    """
    demand, rows = {}, []
    for kind, n in sorted(kinds.items(), reverse=True):
        parts = [(0, n, 1, kind)]
        if kind < 0:
            per = _bundle(-kind, grid, units)
            whole = n - n % per
            parts = [(0, whole, per, -(kind * per // grid)), (whole, n, n - whole, -(kind * (n - whole) // grid))]
        for lo, hi, per, size in parts:
            if hi > lo:
                rows.append((kind, lo, hi, per, size, demand.get(size, 0)))
                demand[size] = demand.get(size, 0) + (hi - lo) // per
    return demand, rows


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, grid: int = GRID, with_ids: bool = False) -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence it lies.

    With ``with_ids`` the ids follow as packed little-endian 32-bit integers.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "packing")
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = plain.mapInArrow(
        _pieces(tokenizer, capacity, with_ids),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")
    kind = F.when(F.col("length") < capacity // 32, -F.col("length")).otherwise(F.ceil(F.col("length") / grid)).cast("int")
    pieces = stages.save((pieces if with_ids else pieces.drop("ids")).withColumn("kind", kind), "pieces")
    # At most capacity / grid + capacity / 32 rows, whatever the input; so are the tables made of them.
    kinds = {r["kind"]: r["n"] for r in pieces.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    demand, items = _items(kinds, grid, capacity // grid)
    items = spark.createDataFrame(items, "ikind int, ilo long, ihi long, iper long, class int, item long")
    places = spark.createDataFrame(
        _places(cutting_stock(demand, capacity // grid)),
        "place int, lo long, hi long, per long, first long, slot long")
    spread = spark.createDataFrame([(k, -(-n // BUCKET_ROWS)) for k, n in kinds.items()], "kind int, buckets long")
    dealt = pieces.join(F.broadcast(spread), "kind")
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.col("buckets"))).drop("buckets")
    counts = dealt.groupBy("kind", "bucket").agg(F.count("*").alias("n"))
    counts = stages.save(counts.withColumn("block", F.floor(F.col("bucket") / BLOCK)), "counts")
    sums = lambda key, *by: F.coalesce(F.sum("n").over(
        Window.partitionBy(*by).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = counts.groupBy("kind", "block").agg(F.sum("n").alias("n")).select("kind", "block", sums("block", "kind").alias("base"))
    counts = counts.withColumn("within", sums("bucket", "kind", "block")).join(blocks, ["kind", "block"])
    counts = counts.select("kind", "bucket", (F.col("base") + F.col("within")).alias("before"))
    order = Window.partitionBy("kind", "bucket").orderBy(F.desc("length"), "doc_id", "start")
    ranked = dealt.withColumn("rank", F.row_number().over(order)).join(counts, ["kind", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") - 1 + F.col("before"))
    within = (F.col("kind") == F.col("ikind")) & (F.col("rank") >= F.col("ilo")) & (F.col("rank") < F.col("ihi"))
    at = F.col("rank") - F.col("ilo")
    ranked = ranked.join(F.broadcast(items), within).withColumn("part", at % F.col("iper"))
    ranked = ranked.withColumn("item", F.col("item") + F.floor(at / F.col("iper")).cast("long"))
    fits = (F.col("class") == F.col("place")) & (F.col("item") >= F.col("lo")) & (F.col("item") < F.col("hi"))
    placed = ranked.join(F.broadcast(places), fits)  # rows: patterns times their classes
    at = F.col("item") - F.col("lo")
    placed = placed.withColumn("sequence_id", F.col("first") + F.floor(at / F.col("per")).cast("long"))
    placed = placed.withColumn("slot", F.col("slot") + at % F.col("per"))
    so_far = Window.partitionBy("sequence_id").orderBy("slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(so_far), F.lit(0)).alias("offset"), *(["ids"] if with_ids else []))


def digest(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the pieces of the documents and their places."""
    return digest(docs)
