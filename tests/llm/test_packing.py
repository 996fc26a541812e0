import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bronzegate.llm import packing

SF = "/root/testdata/sf0.01"


def test_cutting_stock_uses_demand_and_fits():
    rng = random.Random(1)
    for _ in range(20):
        demand = {rng.randint(1, 64): rng.randint(1, 400) for _ in range(rng.randint(1, 40))}
        used = packing.cutting_stock(demand, 64)
        total = defaultdict(int)
        for copies, content in used:
            assert copies > 0 and sum(s * k for s, k in content.items()) <= 64
            for s, k in content.items():
                total[s] += copies * k
        assert total == demand
        whole = sum(s * n for s, n in demand.items())
        large = sum(n for s, n in demand.items() if s > 32)
        # Few more sequences than volume or large pieces force.
        assert sum(c for c, _ in used) <= max(whole / 64, large) * 1.25 + len(demand) + 2
    assert packing.cutting_stock({}, 64) == []


@pytest.mark.parametrize("source", ["sf", "odd"])
def test_pieces_are_whole_and_gapless(spark, source):
    if source == "sf":
        docs = spark.read.parquet(f"{SF}/documents.parquet")
    else:
        rng = random.Random(2)
        rows = [(1, None), (2, ""), (3, "It's 2024: naïve café <|endoftext|>x   İstanbul ΣΑΣ é"), (4, "a " * 9000), (None, "no id"),
                (5, "same"), (5, "same"), (6, " ".join(chr(rng.randrange(33, 0x2FFF)) for _ in range(3000)))]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert packing.digest(docs.limit(0)).count() == 0
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    ids = {i: [*e.ids, 1] for (i, _), e in zip(texts, tok.encode_batch([t or "" for _, t in texts], add_special_tokens=False))}
    copies = defaultdict(int)
    for i, _ in texts:
        copies[i] += 1
    got = packing.digest(docs).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, spans in by_doc.items():
        assert sorted(spans) == sorted([(s, min(2048, len(ids[i]) - s)) for s in range(0, len(ids[i]), 2048)] * copies[i])
    assert by_doc.keys() == ids.keys()
    for spans in by_seq.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 2048
    if source == "sf":
        tokens = sum(map(len, ids.values()))
        assert tokens / (2048 * len(by_seq)) > 0.985


@pytest.mark.parametrize("text,ids", [("a b c d e f g h", 9), (None, 1), ("x " * 42, 43)])
def test_short_documents_fill_their_sequences(spark, text, ids):
    docs = spark.range(4000).selectExpr("id AS doc_id").withColumn("text", F.lit(text).cast("string"))
    got = packing.digest(docs).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert {r["t"] for r in got} == {ids}
    assert sum(r["n"] for r in got) == 4000 * ids and max(r["n"] for r in got) <= 2048
    assert 4000 * ids / (2048 * (len(got) - 1 or 1)) > 0.95


def test_latin_words_equal_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    ids, tok, rng = packing._Words(path).ids, Tokenizer.from_file(path), random.Random(5)
    words = ["".join(chr(rng.randrange(33, 0x260)) for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    words = [w for w in (x.strip() for x in words) if w and not any(c.isspace() for c in w)]
    for w, e in zip(words, tok.encode_batch(words, add_special_tokens=False)):
        assert np.frombuffer(ids[w.encode()], "<u4").tolist() == e.ids, w
