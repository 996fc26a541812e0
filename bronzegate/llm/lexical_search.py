"""Ranked lexical search: the ``k`` best documents of every item, exactly, with range-maximum tables.

Method.  Documents are cut into shards of bounded size.  A shard holds one posting list a
query term (documents in shard order, each with the integer impact its term adds to a
score) and, over each list, a sparse table of range maxima.  An item starts with the whole
shard as one document interval; the sum of its terms' range maxima bounds every score
inside.  Intervals are taken best bound first, a batch at a time; each is split at the
document of its largest single impact, which is scored, and the rest goes left and right.
Intervals of few postings are scored outright, and an interval whose bound is below the
item's ``k``-th score is dropped.  So every document that could be in the result is scored.

Spark's part: one pass over the texts writes each document's query terms and counts; one
aggregate of those gives the document frequencies and lengths that the weights need; a
second pass, without a shuffle, builds the shards of each split and keeps ``k`` documents an
item and task (a shard starts from the best scores of the ones before); a two-step
ranking joins them.  A task's memory follows the shard, not the split or the corpus.

Items are taken in blocks of about ``BLOCK_BYTES`` of text (dealt by hash), so what goes to
every task is bounded whatever the size of the item table; each block is one such pair of
passes.  Terms are compared as 64-bit hashes within a block's few hundred thousand terms.

Scores: w = floor(1000 * ln((2N+2) / (2df+1))), m = 75 + (25*n*N) div L, and a term adds
w * ((1e9*tf) div (1000*tf + 12*m)); all but the logarithm is 64-bit integer arithmetic.

Defined cases: a null or wordless text is no document and an item without terms has no
result; repeated rows are documents (or items) of their own, so an id may come up more
than once in a ranking, with one rank each; a null document id is ranked before all
others of its score; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bronzegate.llm import words as W
from bronzegate.llm.common import Stages

K = 20
BLOCK_BYTES = 1 << 20
#: A shard ends with the batch of documents that reaches one of these.
SHARD_DOCS, SHARD_POSTINGS = 8192, 1_000_000
#: An interval of at most so many postings is scored outright; so many intervals an item are taken at a time.
LEAF, WIDTH = 1024, 24
#: Items searched together, which bounds the arrays of a step.
TOGETHER = 256
NO_ID = np.iinfo(np.int64).min

#: Bytes that part terms: all of ASCII but digits and letters.
PARTING = np.zeros(256, bool)
PARTING[:128] = True
PARTING[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


@dataclass
class Items:
    """A block of items: term hashes (ascending), and each item's terms with their repeats."""

    ids: list
    terms: np.ndarray
    ptr: np.ndarray
    term: np.ndarray
    times: np.ndarray


def items_of(rows: list[tuple]) -> Items:
    hashes = [W.words((text or "").encode().lower(), PARTING)[2] for _, text in rows]
    terms = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]))
    each = [np.unique(h, return_counts=True) for h in hashes]
    return Items([i for i, _ in rows], terms, np.concatenate([[0], np.cumsum([len(h) for h, _ in each])]).astype(np.int64),
                 np.searchsorted(terms, np.concatenate([*(h for h, _ in each), np.zeros(0, np.uint64)])),
                 np.concatenate([*(c for _, c in each), np.zeros(0, np.int64)]).astype(np.int64))


# -- first pass: the query terms of each document

def _count(terms: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, last, raw, starts in W.joined([t.lower() for t in W.texts(batch.column(1))]):
                at, _, h = W.words(raw, PARTING)
                doc = np.searchsorted(starts, at, "right") - 1
                n = np.bincount(doc, minlength=last - first)
                place = np.searchsorted(terms, h)
                place[place == len(terms)] = 0
                hit = terms[place] == h if len(terms) else np.zeros(len(h), bool)
                key, tf = np.unique(doc[hit] * len(terms) + place[hit], return_counts=True)
                doc, term = np.divmod(key, max(len(terms), 1))
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=last - first))]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (term, tf)]
                yield pa.RecordBatch.from_arrays([ids.slice(first, last - first), pa.array(n.astype(np.int64)), *lists],
                                                 names=["id", "n", "term", "tf"]).filter(pa.array(n > 0))

    return run


def _frequencies(n_terms: int):
    """Per task: (term, documents), and under -1 and -2 the documents and their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, length = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches:
            df += np.bincount(batch.column(1).flatten().to_numpy(), minlength=n_terms)
            docs += len(batch)
            length += int(batch.column(0).to_numpy().sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, [-1, -2])), pa.array(np.append(df[held], [docs, length]))],
                                         names=["term", "n"])

    return run


# -- second pass: shards

class Shard:
    """Posting lists of some documents, their sparse tables, and the search in them."""

    def __init__(self, ids, n, ends, term, tf, weight, docs: int, length: int):
        m = 75 + (25 * n * docs) // length
        doc = np.repeat(np.arange(len(n)), np.diff(ends))
        impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        # Like documents side by side keep the range maxima low: by most frequent term (a language's), then by length.
        most = np.full(len(n), -1)
        by_tf = np.lexsort((tf, doc))
        most[doc[by_tf]] = term[by_tf]
        order = np.lexsort((n, most))
        place = np.empty(len(n), np.int64)
        place[order] = np.arange(len(n))
        self.ids, self.size = ids[order], max(len(n), 1)
        key = term.astype(np.int64) * self.size + place[doc]
        held = impact > 0
        by_key = np.argsort(key[held], kind="stable")
        self.key, self.impact = key[held][by_key], impact[held][by_key]
        self.doc = self.key % self.size
        self.ptr = np.searchsorted(self.key, np.arange(len(weight) + 1) * self.size)
        longest = int(np.diff(self.ptr).max(initial=1))
        self.tables = [np.arange(len(self.key), dtype=np.int32)]
        for j in range(1, longest.bit_length()):
            half, last = 1 << (j - 1), self.tables[-1]
            a, b = last[: len(last) - half], last[half:]
            self.tables.append(np.where(self.impact[b] > self.impact[a], b, a))
        self.flat = np.concatenate(self.tables)
        self.level = np.concatenate([[0], np.cumsum([len(t) for t in self.tables])])

    def greatest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the largest impact among the postings [a, b) of one list, for each pair."""
        j = np.frexp((b - a).astype(np.float64))[1] - 1
        x, y = self.flat[self.level[j] + a], self.flat[self.level[j] + b - (1 << j)]
        return np.where(self.impact[y] > self.impact[x], y, x)

    def search(self, items: Items, first: int, last: int, top: Top) -> None:
        """Bring the top lists of the items [first, last) up to date with this shard."""
        node = np.repeat(np.arange(last - first), np.diff(items.ptr[first : last + 1]))
        pair = slice(items.ptr[first], items.ptr[last])
        term = items.term[pair]
        wide = _Intervals(self, np.arange(first, last), node, term, items.times[pair], self.ptr[term], self.ptr[term + 1])
        waiting = [wide]
        while waiting:
            pool = _Intervals.together(waiting)
            kth = top.kth[pool.item]
            order = np.lexsort((-pool.bound, pool.item))
            order = order[((pool.bound > 0) & (pool.bound >= kth))[order]]
            if not len(order):
                return
            item = pool.item[order]
            begins = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
            rank = np.arange(len(item)) - np.repeat(begins, np.diff(np.append(begins, len(item))))
            now, later = pool.take(order[rank < WIDTH]), pool.take(order[rank >= WIDTH])
            small = now.postings <= LEAF
            found = [now.take(np.flatnonzero(small)).scores()]
            children, middle = now.take(np.flatnonzero(~small)).split()
            top.add(*(np.concatenate(x) for x in zip(*found, middle)), self.ids)
            waiting = [x for x in (later, children) if len(x.item)]


class _Intervals:
    """Document intervals of items: for each of an item's terms left in it, the range of postings and its maximum.

    Pairs (interval, term) are kept in order of the interval, empty ranges dropped.
    """

    def __init__(self, shard, item, node, term, times, a, b, best=None):
        self.shard, self.item = shard, item
        if best is None:
            full = b > a
            node, term, times, a, b = node[full], term[full], times[full], a[full], b[full]
            best = shard.greatest(a, b)
        self.node, self.term, self.times, self.a, self.b, self.best = node, term, times, a, b, best
        self.ptr = np.searchsorted(node, np.arange(len(item) + 1))
        value = times * shard.impact[best]
        self.bound = self._sums(value)
        self.postings = self._sums(b - a)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.ptr[1:]] - total[self.ptr[:-1]]

    @staticmethod
    def together(parts: list[_Intervals]) -> _Intervals:
        if len(parts) == 1:
            return parts[0]
        base = np.cumsum([0, *(len(p.item) for p in parts)])
        return _Intervals(parts[0].shard, np.concatenate([p.item for p in parts]),
                          np.concatenate([p.node + at for p, at in zip(parts, base)]),
                          *(np.concatenate([getattr(p, f) for p in parts]) for f in ("term", "times", "a", "b", "best")))

    def take(self, which: np.ndarray) -> _Intervals:
        pairs, node = _ranges(self.ptr[which], self.ptr[which + 1])
        return _Intervals(self.shard, self.item[which], node,
                          *(getattr(self, f)[pairs] for f in ("term", "times", "a", "b", "best")))

    def scores(self) -> tuple[np.ndarray, ...]:
        """(item, document, score) of every document in the intervals."""
        at, pair = _ranges(self.a, self.b)
        key = self.node[pair] * self.shard.size + self.shard.doc[at]
        return self._sum_by(key, self.times[pair] * self.shard.impact[at])

    def _sum_by(self, key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.argsort(key, kind="stable")
        key = key[order]
        begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        score = np.add.reduceat(value[order], begins) if len(key) else np.zeros(0, np.int64)
        node, doc = np.divmod(key[begins], self.shard.size)
        return self.item[node], doc, score

    def split(self) -> tuple[_Intervals, tuple[np.ndarray, ...]]:
        """The parts left and right of each interval's document of largest impact, and that document's score."""
        n, shard = len(self.item), self.shard
        value = self.times * shard.impact[self.best]
        order = np.lexsort((value, self.node))
        mid = shard.doc[self.best[order[self.ptr[1:] - 1]]] if n else np.zeros(0, np.int64)
        of = mid[self.node]
        p = np.searchsorted(shard.key, self.term.astype(np.int64) * shard.size + of)
        p = np.clip(p, self.a, self.b)
        held = (p < self.b) & (shard.doc[np.minimum(p, len(shard.doc) - 1)] == of)
        middle = self._sum_by((self.node * shard.size + of)[held], (self.times[held] * shard.impact[p[held]]))
        left = _Intervals(shard, self.item, self.node, self.term, self.times, self.a, p)
        right = _Intervals(shard, self.item, self.node, self.term, self.times, p + held, self.b)
        return _Intervals.together([left, right]), middle


def _ranges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [a, b), one after another, and the range each is of."""
    size = b - a
    of = np.repeat(np.arange(len(a)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + a[of], of


class Top:
    """The ``k`` best (score, document) of each item so far; equal scores by ascending id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.item, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.kth = np.zeros(n, np.int64)

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        good = (score > 0) & (score >= self.kth[item])
        if not good.any():
            return
        item = np.concatenate([self.item, item[good]])
        score = np.concatenate([self.score, score[good]])
        ids = np.concatenate([self.id, ids[doc[good]]])
        order = np.lexsort((ids, -score, item))
        item = item[order]
        begins = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        rank = np.arange(len(item)) - np.repeat(begins, np.diff(np.append(begins, len(item))))
        best = rank < self.k
        self.item, self.score, self.id = item[best], score[order[best]], ids[order[best]]
        full = rank[best] == self.k - 1
        self.kth[self.item[full]] = self.score[full]


def _search(items: Items, weight: np.ndarray, docs: int, length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, held, rows, postings = Top(len(items.ids), k), [], 0, 0

        def flush():
            table = pa.Table.from_batches(held)
            ids = table.column("id").cast(pa.int64()).fill_null(int(NO_ID)).to_numpy()
            term, tf = (table.column(c).combine_chunks() for c in ("term", "tf"))
            ends = np.concatenate([[0], np.cumsum(np.asarray(term.value_lengths()))])
            shard = Shard(ids, table.column("n").to_numpy(), ends, term.flatten().to_numpy().astype(np.int64),
                          tf.flatten().to_numpy().astype(np.int64), weight, docs, length)
            for first in range(0, len(items.ids), TOGETHER):
                shard.search(items, first, min(first + TOGETHER, len(items.ids)), top)

        for batch in batches:
            for at in range(0, len(batch), 512):  # a batch of long documents may itself be many shards
                part = batch.slice(at, 512)
                held.append(part)
                rows, postings = rows + len(part), postings + len(part.column(2).flatten())
                if rows >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    flush()
                    held, rows, postings = [], 0, 0
        if held:
            flush()
        ids = pa.array(top.id, mask=top.id == NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(top.item), ids, pa.array(top.score)], names=["item", "id", "score"])

    return run


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def lexical_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", k: int = K) -> DataFrame:
    """(item_col, rank, id_col, score): the ``k`` best documents of each item, best first."""
    spark = docs.sparkSession
    stages = Stages(spark, "lexical_search")
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = math.ceil((size + 1) / BLOCK_BYTES)
    results = []
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).orderBy("item", "text")
        rows = [tuple(r) for r in block.collect()]  # about BLOCK_BYTES of text
        some = items_of(rows)
        counted = stages.save(plain.mapInArrow(_count(some.terms), "id long, n long, term array<int>, tf array<int>"), f"terms-{b}")
        sums = counted.select("n", "term").mapInArrow(_frequencies(len(some.terms)), "term long, n long").groupBy("term").agg(F.sum("n"))
        held = dict(tuple(r) for r in sums.collect())  # one row a term of the block
        n_docs, length = held.get(-1, 0), held.get(-2, 0)
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(some.terms))], np.int64)
        found = counted.mapInArrow(_search(some, weight, n_docs, length, k), "item long, id long, score long")
        part = found.withColumn("part", F.spark_partition_id() % 256)
        best = _ranked(_ranked(part, ["item", "part"], k), ["item"], k)
        names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(rows)], f"item long, id {asked.schema['item'].dataType.simpleString()}")
        results.append(best.join(names.withColumnRenamed("id", "name"), "item").select(
            F.col("name").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return lexical_search(docs, items).select("item_id", "rank", "doc_id", "score")
