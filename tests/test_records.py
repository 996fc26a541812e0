"""Capped lists per pair (J3) and rollup state that merges over batches."""

import random

from pyspark.sql import functions as F

from bronzegate import schemas as S
from bronzegate.operators import records as R


def test_lists_keep_the_smallest_and_the_count(spark):
    rng = random.Random(3)
    rows = [(f"q{p}", f"s{p}", f"id{rng.randrange(10**6):06d}-{i}") for p in range(4) for i in range([1, 5, 30, 700][p])]
    df = spark.createDataFrame(rows, "FILE_WITH string, FILE_WITHOUT string, MISSING_ID string")
    got = {r["FILE_WITH"]: (r["FILE_WITHOUT"], r["MISSING_IDS"], r["n_missing"]) for r in R.uncovered_id_lists(df, 20).collect()}
    for p in range(4):
        ids = sorted(r[2] for r in rows if r[0] == f"q{p}")
        assert got[f"q{p}"] == (f"s{p}", ids[:20], len(ids))
    assert R.uncovered_id_lists(df.limit(0)).count() == 0


def test_batches_merge_to_the_counts_of_the_whole(spark):
    rng = random.Random(4)
    rows = [(f"f{rng.randrange(3)}", rng.choice(["", None, *"abcdefgh"]), str(rng.randrange(3)), str(rng.randrange(200))) for _ in range(900)]
    schema = f"FILE_NAME string, `{S.RESIDENT_COLUMN}` string, `{S.FACILITY_COLUMN}` string, {S.ID_COLUMN} string"
    parts = [spark.createDataFrame([(a, b or "", c, d) for a, b, c, d in x], schema) for x in (rows[:300], rows[300:800], rows[800:])]
    dictionary, states = None, []
    for part in parts:
        dictionary = R.value_dictionary(part, dictionary).cache()
        states.append(R.rollup_state(part, dictionary))
    assert dictionary.groupBy("id").count().where("count > 1").isEmpty()
    got = {r["FILE_NAME"]: tuple(r)[1:] for r in R.state_counts(R.merge_states(*states)).collect()}
    for f in got:
        mine = [r for r in rows if r[0] == f]
        assert got[f] == (len({r[1] or "" for r in mine}), len({r[2] for r in mine}), len({r[3] for r in mine}))
    plan = R.rollup_state(parts[0], dictionary)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
