"""Benchmark decontamination by template windows and slot consistency.

Method: texts become templates: numbers, names and units are typed placeholders, all
other words have their case folded.  Windows of ``WINDOW`` template words are hash-joined
with those of the benchmark items.  Matches of one item at one offset of a document, as
far as their windows overlap or touch, are a run; its slots (the words behind the
placeholders) must map one-to-one from item to document, else the run is refused.  A
copy has equal slots, a re-parameterised question has other ones, used consistently.

Letter case says what a name is, so every text has three forms, and a document is held
against an item form by form through the same join: ``TYPED`` with names, numbers and units
as placeholders; ``CASELESS`` with numbers and units only, names being literal; and
``VERBATIM`` with none, all words of a window being equal.

* Words are runs of ASCII letters and digits and of non-ASCII characters other than
  punctuation, symbols and spaces, so punctuation does not matter.  A number is a word that starts with a digit (``1,000`` is
  one); a unit is a word of ``UNITS`` after a number; a name is a run of words with an
  ASCII capital that does not follow a sentence end.  A window with
  placeholders counts only with at least ``LITERALS`` words that are not.
* An item with fewer template words than a window is one window of its own length.  With
  placeholders that takes ``SHORTEST`` words; a verbatim window may be of any length and
  hold any words, so an item of one word takes every document with that word.
* Item windows are counted; up to ``KNOWN`` of them go to the tasks as a sorted array, so only
  matching windows leave Python; beyond that all windows go through the same join.

A document is contaminated by an item when, in one of the forms, consistent runs match at
least the share ``COVERAGE`` of the item's windows.  Result: one row per document and item,
with the windows of the form that matches most.

Defined cases: null text or item text is empty and matches nothing; null ids are not
reported; equal rows are reported once; an empty table on either side gives an empty
result; extra columns are not looked at.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bronzegate.llm import words as W
from bronzegate.llm.common import Stages, read, small

WINDOW, LITERALS, SHORTEST = 10, 5, 6
COVERAGE = 0.3
KNOWN = 1_000_000

# Measuring units, lower case.
UNITS = """
mm cm m km inch inches ft foot feet yard yards mile miles mg g kg gram grams lb lbs pound pounds oz ounce ounces ton tons tonnes
ml l liter liters litre litres gallon gallons s sec secs second seconds min mins minute minutes h hr hrs hour hours day days
week weeks month months year years cent cents dollar dollars euro euros usd eur percent degree degrees kmh mph watt watts volt volts
""".split()

LITERAL, NUMBER, NAME, UNIT = range(4)
TYPED, CASELESS, VERBATIM = range(3)
_FORM = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_PLACE = np.array([0, 0x51ED270B, 0x7F4A7C15, 0x2545F491], np.uint64)
_BREAK = np.ones(256, bool)
_BREAK[0x80:] = False
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    _BREAK[_a:_b] = False
_END = np.zeros(256, np.int64)
_END[[ord(c) for c in ".!?:;\n"]] = 1
# Punctuation, symbols and spaces beyond ASCII.
_MARKS = re.compile("[" + "".join(chr(i) for i in [*range(0x80, 0x3100), *range(0xFE00, 0x10000)] if unicodedata.category(chr(i))[0] in "PSZ") + "]")
_UNIT_HASHES = np.sort(np.concatenate([W.words(u.encode(), _BREAK)[2] for u in UNITS]))


def _folded(part: bytes) -> tuple[bytes, bytes]:
    """The text with blanks for non-ASCII punctuation, and that with its case folded: word for word the same."""
    if part.isascii():
        return part, part.lower()
    text = _MARKS.sub(" ", part.decode("utf-8", "surrogateescape"))
    return text.encode("utf-8", "surrogateescape"), text.casefold().encode("utf-8", "surrogateescape")


def _templates(raw: bytes, folded: bytes, starts: np.ndarray):
    """Per form: (text, kinds, template hashes, slot hashes) of all template words in order."""
    begin, end, hashes = W.words(folded, _BREAK)
    if len(raw) != len(folded) or not raw.isascii():
        begin, end, _ = W.words(raw, _BREAK)
    data = np.frombuffer(raw, np.uint8)
    first = data[begin] if len(begin) else np.zeros(0, np.uint8)
    text = np.searchsorted(starts, begin, "right") - 1
    opens = np.ones(len(begin), bool)
    opens[1:] = text[1:] != text[:-1]
    ends = np.concatenate([[0], np.cumsum(_END[data])])
    fresh = opens.copy()  # first of a sentence
    fresh[1:] |= ends[begin[1:]] > ends[end[:-1]]
    number = (first >= 0x30) & (first <= 0x39)
    after = np.zeros(len(begin), bool)
    after[1:] = number[:-1] & ~opens[1:]
    at = np.searchsorted(_UNIT_HASHES, hashes)
    unit = after & ~number & (_UNIT_HASHES[np.minimum(at, len(_UNIT_HASHES) - 1)] == hashes)
    name = (first >= 0x41) & (first <= 0x5A) & ~fresh
    for form in (TYPED, CASELESS):
        kind = np.where(number, NUMBER, LITERAL)
        if form == TYPED:
            kind[name] = NAME
        kind[unit] = UNIT
        # A run of names, or of numbers parted by one "." or ",", is one template word.
        same = np.zeros(len(begin), bool)
        if len(begin) > 1:
            gap = data[end[:-1]]
            close = (begin[1:] - end[:-1] == 1) & ((gap == 0x2E) | (gap == 0x2C))
            same[1:] = (kind[1:] == kind[:-1]) & ~opens[1:] & ((kind[1:] == NAME) | ((kind[1:] == NUMBER) & close))
        heads = np.flatnonzero(~same)
        slot = hashes
        if len(heads):
            slot = W.mix(np.add.reduceat(hashes * (np.arange(len(hashes)).astype(np.uint64) * np.uint64(2) + np.uint64(1) - np.repeat(heads, np.diff(np.append(heads, len(hashes)))).astype(np.uint64) * np.uint64(2)), heads))
        kind = kind[heads]
        yield text[heads], kind, np.where(kind == LITERAL, hashes[heads], W.mix(_PLACE[kind])), slot
    yield text, np.zeros(len(text), np.int64), hashes, hashes


def _windows(form: int, text: np.ndarray, kind: np.ndarray, template: np.ndarray, size: int):
    """(positions, hashes) of the windows that lie in one text and hold enough literal words."""
    hashes = W.windows(template, size)
    if not len(hashes):
        return np.zeros(0, np.int64), hashes
    good = text[: len(hashes)] == text[size - 1 :]
    if form != VERBATIM:
        literal = np.concatenate([[0], np.cumsum(kind == LITERAL)])
        good &= literal[size:] - literal[:-size] >= min(LITERALS, size)
    good = np.flatnonzero(good)
    return good, hashes[good] ^ _FORM[form]


def _rows(sizes: list[tuple[int, int]], known: np.ndarray | None, items: bool):
    """Window rows of every text; ``items``: a text shorter than ``WINDOW`` is one window."""
    table = None
    if known is not None:
        table = np.zeros(1 << 16, bool)
        table[known >> np.uint64(48)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, both = batch.column(0).to_pylist(), [_folded(t) for t in W.texts(batch.column(1))]
            for first, last, raw, starts in W.joined([t for t, _ in both]):
                doc, pos, hashes, slots, size_of, total, form_of = [], [], [], [], [], [], []
                folded = b"\n".join(t for _, t in both[first:last])
                for form, (text, kind, template, slot) in enumerate(_templates(raw, folded, starts)):
                    begin = np.searchsorted(text, np.arange(last - first + 1))
                    length = np.minimum(np.diff(begin), WINDOW)
                    least = 1 if form == VERBATIM else SHORTEST
                    for size in [n for n in np.unique(length).tolist() if n >= least] if items else [n for f, n in sizes if f == form]:
                        at, h = _windows(form, text, kind, template, size)
                        if items:
                            own = length[text[at]] == size
                            at, h = at[own], h[own]
                        every = np.bincount(text[at], minlength=last - first)
                        if known is not None:
                            hit = np.flatnonzero(table[h >> np.uint64(48)])
                            if len(hit):
                                place = np.minimum(np.searchsorted(known, h[hit]), len(known) - 1)
                                hit = hit[known[place] == h[hit]]
                            at, h = at[hit], h[hit]
                        if form == VERBATIM and not items:  # without slots one of equal windows of a text is enough
                            once = np.lexsort((h, text[at]))
                            once = once[np.concatenate([[True], (h[once][1:] != h[once][:-1]) | (text[at][once][1:] != text[at][once][:-1])])] if len(once) else once
                            at, h = at[once], h[once]
                        for p, i, x in zip(at.tolist(), text[at].tolist(), h.view(np.int64).tolist()):
                            if ids[first + i] is None:
                                continue
                            doc.append(ids[first + i]), pos.append(p - int(begin[i])), hashes.append(x)
                            size_of.append(size), total.append(int(every[i])), form_of.append(form)
                            slots.append(slot[p : p + size][kind[p : p + size] != LITERAL].view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(pos, pa.int64()), pa.array(hashes, pa.int64()), pa.array(slots, pa.list_(pa.int64())),
                     pa.array(size_of, pa.int64()), pa.array(total, pa.int64()), pa.array(form_of, pa.int64())],
                    names=["id", "pos", "hash", "slots", "size", "total", "form"])

    return run


_SCHEMA = "id long, pos long, hash long, slots array<long>, size long, total long, form long"


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """(doc id, item id, n_windows, item_windows, exact) of every contaminated pair."""
    spark = docs.sparkSession
    stages = Stages(spark, "decontaminate")
    plain = lambda df, i, t: df.select(F.col(i).cast("long").alias("id"), F.col(t).cast("string").alias("text"))
    wanted = stages.save(plain(items, item_id, item_text).mapInArrow(_rows([], None, True), _SCHEMA), "items")
    n = wanted.count()
    sizes = sorted((r["form"], r["size"]) for r in wanted.select("form", "size").distinct().collect())  # at most WINDOW a form
    known = None
    if n <= KNOWN:  # counted: at most 8 bytes times KNOWN
        known = np.array(sorted(r["hash"] % 2**64 for r in wanted.select("hash").distinct().collect()), np.uint64)
        if not len(known):
            known = np.zeros(1, np.uint64)
    found = plain(docs, id_col, text_col).mapInArrow(_rows(sizes, known, False), _SCHEMA)
    found = stages.save(found.select("id", "pos", "hash", "slots", "size"), "found")
    theirs = wanted.select(F.col("id").alias("item"), F.col("pos").alias("item_pos"), "hash", F.col("slots").alias("item_slots"), "size", "total", "form")
    hits = found.join(small(theirs, n), ["hash", "size"]).withColumn("shift", F.col("pos") - F.col("item_pos"))
    hits = hits.select("id", "item", "form", "shift", "item_pos", "size", "total", "slots", "item_slots").distinct()
    offset = Window.partitionBy("id", "item", "form", "shift").orderBy("item_pos")  # at most the item's windows
    apart = (F.col("item_pos") - F.lag("item_pos").over(offset) > F.col("size")).cast("int")
    hits = hits.withColumn("apart", F.coalesce(apart, F.lit(0)))
    hits = stages.save(hits.withColumn("run", F.sum("apart").over(offset)).drop("apart"), "hits")
    run = ["id", "item", "form", "shift", "run"]
    slots = (
        hits.where(F.size("slots") > 0)
        .select(*run, F.explode(F.arrays_zip("slots", "item_slots")).alias("s")).distinct()
        .groupBy(*run).agg(F.count("*").alias("n"), F.countDistinct("s.slots").alias("a"), F.countDistinct("s.item_slots").alias("b"),
                           F.max((F.col("s.slots") != F.col("s.item_slots")).cast("int")).alias("changed"))
    )
    slots = stages.save(slots, "slots")
    sound = hits.join(slots, run, "left").where("n is null or (n = a and n = b)")
    per_form = sound.groupBy("id", "item", "form").agg(
        F.countDistinct("item_pos").alias("n_windows"), F.max("total").alias("item_windows"),
        F.max(F.coalesce("changed", F.lit(0))).alias("changed"))
    per_form = per_form.where(F.col("n_windows") >= F.col("item_windows") * F.lit(coverage))
    best = F.max(F.struct((F.col("n_windows") / F.col("item_windows")).alias("share"), -F.col("form"), "n_windows", "item_windows"))
    return stages.finish(per_form.groupBy("id", "item").agg(best.alias("best"), (F.max("changed") == 0).alias("exact")).select(
        F.col("id").alias(id_col), F.col("item").alias(item_id), "best.n_windows", "best.item_windows", "exact"))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go.

    A document is its id and text, so another text under the same id stays; a null id is judged like any other.
    """
    key = F.xxhash64("doc_id", "text")
    found = contaminated(docs.select(key.alias("__dc_key"), "text"), read(spark, sf_dir, "benchmark").select("item_id", "text"), id_col="__dc_key")
    return docs.join(small(found.select("__dc_key").distinct()), key == F.col("__dc_key"), "left_anti")
