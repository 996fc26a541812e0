"""Pipeline stages on repeated ids, and the stored tables they leave."""

import os

import corpus_pipeline
import pytest

from bronzegate.llm import decontaminate, minhash_dedup
from bronzegate.llm.common import Stages

SF = "/root/testdata/sf0.001"


def _words(tag, n=60):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_minhash_stage_keeps_one_text_of_every_group(spark):
    x, y, z = _words("x"), _words("y"), _words("z")
    rows = [(3, y, 1), (5, x, 2), (5, y, 3), (9, x + " tail", 4), (7, z, 5), (7, z, 6), (8, z + " end", 7),
            (5, "", 8), (5, _words("q"), 9), (11, _words("q"), 10), (None, x, 11), (12, None, 12), (12, None, 13), (4, "", 14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grp long")
    kept = minhash_dedup.stage(spark, docs, SF)
    assert kept.columns == docs.columns
    got = sorted(kept.collect(), key=str)
    ids = [(r["doc_id"], r["text"]) for r in got]
    expected = [(3, y), (5, x), (7, z), (5, ""), (5, _words("q")), (None, x), (12, None), (4, "")]
    assert sorted(ids, key=str) == sorted(expected, key=str)
    assert minhash_dedup.stage(spark, docs.limit(0), SF).count() == 0


def test_decontaminate_stage_drops_the_text_not_the_id(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(1, item), (1, _words("clean")), (2, None), (None, "before " + item), (None, _words("other"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in decontaminate.stage(spark, docs, SF).collect()), key=str)
    assert got == sorted([(1, _words("clean")), (2, None), (None, _words("other"))], key=str)


def test_finished_operators_leave_their_result_only(spark):
    stages = Stages(spark, "probe")
    a = stages.save(spark.range(5), "a")
    stages.save(spark.range(3), "b"), stages.save(spark.range(4), "b")
    stages.drop("b", older=True)
    assert len(os.listdir(stages.root.removeprefix("file:"))) == 2
    out = stages.finish(a.where("id > 1"))
    assert out.count() == 3 and len([x for x in os.listdir(stages.root.removeprefix("file:")) if "result" not in x]) == 0


@pytest.fixture(scope="module")
def stored(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for name, step in corpus_pipeline.STAGES[:-1]:
        tables.append(Stages(spark, "stored").save(step(spark, tables[-1], SF), name))
    return tables


def test_pipeline_packs_what_its_stages_keep(spark, stored):
    """Stage columns, no document invented, and run() packs each kept id whole."""
    for before, after in zip(stored, stored[1:]):
        assert after.columns == before.columns
        assert after.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
    packed = corpus_pipeline.run(spark, SF).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in stored[-1].select("doc_id").collect()}
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in packed)
