import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bronzegate.llm import lexical_search as L
from tests.llm.brute import UP

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(t):
    return TERM.findall((t or "").translate(UP))


def ranked(docs, items, k=20):
    """(item, rank, doc, score) by scoring every document."""
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, ts, {x: ts.count(x) for x in set(ts)}) for i, ts in held if ts]
    n_docs, length = len(held), sum(len(ts) for _, ts, _ in held)
    df = {}
    for _, _, tf in held:
        for x in tf:
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for doc, ts, tf in held:
            m = 75 + (25 * len(ts) * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * tf[x]) // (1000 * tf[x] + 12 * m))
                    for x in terms(text) if x in tf)
            if s > 0:
                scores.append((-s, doc is not None, doc))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(scores[:k])]
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["Été", "straße", "ÉTÉ", "a1", "x-y", "don't"]
    docs = [(i, " ".join(rng.choices(vocab, weights=range(len(vocab), 0, -1), k=rng.randint(1, 80)))) for i in range(400)]
    docs += [(900 + i, "w1 W2,w3") for i in range(60)]  # ties by id
    docs += [(1000, None), (1001, ""), (1002, " .,;\n"), (1003, " ".join(rng.choices(vocab, k=30000))), (None, "w1 w59 été"),
             (7, docs[7][1]), (7, docs[7][1]), (8, "another text of eight w1")]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 40)))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "..."), (103, "nowhere seen"), (104, "w1 w1 w1 w1 w2"), (104, "w3"), (None, "w1 Été"), (105, "w1 w2 w3")]
    return docs, items


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_scoring_all(spark, corpus):
    docs, items = corpus
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit(1)).withColumn("score", F.lit("x")).repartition(5)
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash")).withColumn("rank", F.lit(0))
    assert rows(L.digest(d, b)) == sorted(ranked(docs, items), key=repr)


def test_blocks_of_items(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(L, "BLOCK_BYTES", 1500)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows(L.lexical_search(d, b, k=3)) == sorted(ranked(docs, items, 3), key=repr)


@pytest.mark.parametrize("leaf, width, shard", [(1, 1, 50), (8, 2, 10**6), (64, 24, 100), (10**9, 1, 10**6)])
def test_search_at_every_setting(corpus, monkeypatch, leaf, width, shard):
    docs, items = corpus
    monkeypatch.setattr(L, "LEAF", leaf)
    monkeypatch.setattr(L, "WIDTH", width)
    monkeypatch.setattr(L, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(L, "TOGETHER", 7)
    some = L.items_of(items)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array([t for _, t in docs])], names=["id", "text"])
    counted = [r.slice(i, 40) for r in L._count(some.terms)(iter([batch])) for i in range(0, len(r), 40)]
    sums = [r for r in L._frequencies(len(some.terms))(iter([pa.RecordBatch.from_arrays([r.column(1), r.column(2)], names=["n", "term"]) for r in counted]))]
    held = dict(zip(*(c.to_pylist() for c in sums[0].columns)))
    weight = np.array([math.floor(1000 * math.log((2 * held[-1] + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(some.terms))], np.int64)
    (out,) = L._search(some, weight, held[-1], held[-2], 20)(iter(counted))
    got = {}
    for i, d, s in zip(*(c.to_pylist() for c in out.columns)):
        got.setdefault(i, []).append((s, d))
    for j, item in enumerate(items):
        want = [(s, d) for _, _, d, s in ranked(docs, [item])]
        assert got.get(j, []) == want


def test_empty_tables(spark, corpus):
    docs, items = corpus
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert L.digest(d.limit(0), b).count() == 0 and L.digest(d, b.limit(0)).count() == 0
    assert L.digest(d.where("doc_id = 1001"), b).count() == 0
    assert L.digest(d, b).columns == ["item_id", "rank", "doc_id", "score"]
