"""Semi joins of texts with ids: the texts of other ids do not move."""

import pytest

from bronzegate.llm import bloom, kn_quality, minhash_dedup, suffix_dedup
from bronzegate.llm.common import Stages, setting

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def plans(monkeypatch):
    """The plans of all stored tables, by name."""
    found, save = {}, Stages.save

    def spied(self, df, name, *args, **kw):
        found[name] = df._jdf.queryExecution().executedPlan().toString()
        return save(self, df, name, *args, **kw)

    monkeypatch.setattr(Stages, "save", spied)
    return found


def test_filter_keeps_what_the_exact_join_keeps(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 7000 if i % 50 else None, f"t{i}") for i in range(9000)], "id long, text string")
    ids = spark.range(0, 30000, 10).union(spark.range(100_000, 101_000))
    want = _rows(rows.join(ids, "id", "left_semi"))
    assert _rows(bloom.having(rows, ids, "id", Stages(spark, "probe"))) == want
    monkeypatch.setattr(bloom, "BROADCAST_ROWS", 100)
    assert _rows(bloom.having(rows, ids, "id", Stages(spark, "probe"))) == want
    monkeypatch.setattr(bloom, "FILTER_ROWS", 3)  # a filter that is full passes everything
    assert _rows(bloom.having(rows, ids, "id", Stages(spark, "probe"))) == want
    assert bloom.having(rows, ids.limit(0), "id", Stages(spark, "probe")).count() == 0


def test_texts_of_other_ids_do_not_move(spark, monkeypatch, plans):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    monkeypatch.setattr(bloom, "BROADCAST_ROWS", 0)  # as if the ids were too many to broadcast
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        kn_quality.digest(docs, labels), minhash_dedup.digest(docs)
    for name in ("trusted", "sets"):
        # The upper join of the plan is the exact one, below it stands the filter.
        assert plans[name].index("SortMergeJoin [id") < plans[name].index("BroadcastHashJoin [pmod")


def test_join_with_facts_keeps_what_the_exact_join_keeps(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 7000 if i % 50 else None, f"t{i}") for i in range(9000)], "id long, text string")
    facts = spark.range(0, 30000, 10).selectExpr("id", "id * 3 AS size")
    want = _rows(rows.join(facts, "id"))
    assert _rows(bloom.meeting(rows, facts, "id", Stages(spark, "probe"))) == want
    monkeypatch.setattr(bloom, "BROADCAST_ROWS", 100)
    assert _rows(bloom.meeting(rows, facts, "id", Stages(spark, "probe"))) == want


def test_bands_outside_shared_buckets_do_not_move(spark, monkeypatch, plans):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(bloom, "BROADCAST_ROWS", 0)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        minhash_dedup.digest(docs)
    assert plans["crowded"].index("SortMergeJoin [key") < plans["crowded"].index("BroadcastHashJoin [pmod")


def test_surroundings_outside_shared_keys_do_not_move(spark, monkeypatch, plans):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(bloom, "BROADCAST_ROWS", 0)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        suffix_dedup.digest(docs)
    assert plans["lists"].index("SortMergeJoin [key") < plans["lists"].index("BroadcastHashJoin [pmod")
