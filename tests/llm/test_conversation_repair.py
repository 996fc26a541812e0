import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from bronzegate.llm import conversation_repair as R

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """(cost, edits) of all ways by dynamic programming; a row is (must go, is truncated, initial)."""

    def inserts(ways):
        ways = dict(ways)
        for _ in range(3):
            for s, (c, e) in list(ways.items()):
                ways[NEXT[s]] = min(ways.get(NEXT[s], (c + 2, e + "I")), (c + 2, e + "I"))
        return ways

    ways = {"": (0, "")}
    for must, cut, initial in rows:
        new = {}
        for s, (c, e) in inserts(ways).items():
            options = [(s, (c + 3, e + "D"))]
            if not must:
                options.append((NEXT[s], (c + 2 + cut, e + "R")))
                if initial and s + initial in ("s", "u", "su", "ua", "au"):
                    options.append((initial, (c + cut, e + "K")))
            for to, way in options:
                new[to] = min(new.get(to, way), way)
        ways = new
    ways = inserts(ways)
    return min(ways[s] for s in ("", "a") if s in ways)


def random_rows(rng, n):
    return [(rng.random() < 0.15, rng.random() < 0.2, rng.choice("suauauaux")) for _ in range(n)]


def test_search_is_cheapest_and_least():
    rng = random.Random(3)
    for _ in range(1500):
        rows = random_rows(rng, rng.choice([0, 1, 2, 3, 5, 8, 13]))
        assert R.search(rows) == cheapest(rows)


def test_segments_add_up(monkeypatch):
    monkeypatch.setattr(R, "SEGMENT", 3)
    rng = random.Random(4)
    for _ in range(300):
        rows = random_rows(rng, rng.randint(4, 30))
        edits, _ = R._solve(rows, True)
        assert "".join(e for (e,) in edits) == cheapest(rows)[1]


def test_runs_add_up(monkeypatch):
    """Parts of one conversation, solved apart, join to the way of the whole."""
    import pyarrow as pa

    monkeypatch.setattr(R, "SEGMENT", 5)
    rng = random.Random(5)
    for _ in range(150):
        parts = [random_rows(rng, rng.choice([0, 1, 4, 11])) for _ in range(rng.randint(1, 5))]
        solved = [R._solve(p, False) if p else ([], R.Summed()) for p in parts]
        table = pa.table({"run": list(range(len(parts))), "at": list(range(len(parts))),
                          "cost": [[t.cost[e].get(x) for e in range(4) for x in range(4)] for _, t in solved],
                          "rank": [[t.rank[e].get(x) for e in range(4) for x in range(4)] for _, t in solved]})
        joined = R._join_runs(table).to_pylist()
        audit = "".join(row[j["way"]] for (edits, _), j in zip(solved, joined) for row in edits) + joined[-1]["tail"]
        assert audit == cheapest([r for p in parts for r in p])[1]


def repaired(conv, rows):
    """The query's row of one conversation; rows are (turn, role, text)."""
    live = []
    for turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if way:
            text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
            live += [(turn is not None, turn, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    live.sort(key=lambda r: (r[0], r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in live:
        said = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    cost, audit = cheapest([(f in ("blank", "duplicate"), f == "truncated", r[2][:1]) for f, r in zip(faults, live)])
    state, out, rest = "", [], iter(live)
    for e in audit:
        if e == "D":
            next(rest)
            continue
        role, text = ("", "") if e == "I" else next(rest)[2:]
        state = role[:1] if e == "K" else NEXT[state]
        out.append(f"{role if e == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{text}")
    turns = [r[1] for r in live if r[0]]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(live, live[1:]))
    return (conv, min(gaps, 2**63 - 1), *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


@pytest.fixture(scope="module")
def table():
    rng = random.Random(6)
    roles = ["user", "assistant", "system", "tool", "unknown", "User", "", None]
    texts = ["Yes.", "No", "Why? ", "Ends.\x85", "a.\n\n", " ", "", None, "Étion!", "dots. inside", "x" * 40]
    rows = [(i, t, rng.choice(roles[:3] if i % 3 else roles), rng.choice(texts) if rng.random() < 0.4 else f"Text {i} {t}.") for i in range(200) for t in range(rng.randint(1, 9))]
    rows += [(1000, t, ["user", "assistant"][t % 2 ^ (rng.random() < 0.1)], rng.choice([f"Row {t}.", f"Row {t}", "Same.", f"Row {t}!"])) for t in range(1500)]
    rows += [(None, t, "user", "Null id.") for t in (None, 1, 1, 2, None)] + [(1001, 2**63 - 1, "user", "a."), (1001, -(2**63), "assistant", "b.")]
    rows += [(1002, 0, "user", "long words " * 50000 + "."), (1003, None, None, None)] + [(1004, 5, "user", "Tied."), (1004, 5, "assistant", "Tied.")] * 3
    dropped = next(t for t in range(10**4) if zlib.crc32(f"1005:{t}".encode()) % 20 == 0)
    return rows + [(1005, dropped, "user", "Goes.")]


def test_digest(spark, table):
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").withColumn("at", F.lit("x")).withColumn("dropped", F.lit(None))
    got = {r[0]: tuple(r) for r in R.digest(df.repartition(7)).collect()}
    convs = {r[0] for r in table}
    assert set(got) == convs
    for c in convs:
        assert got[c] == repaired(c, [r[1:] for r in table if r[0] == c])
    assert got[1005] == (1005, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_long_conversation_lies_in_many_tasks(spark, table):
    """The hot conversation is cut by the range partitions, and its parts join to one answer."""
    from bronzegate.llm.common import Stages

    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([r for r in table if r[0] == 1000], "conv_id long, turn long, role string, text string")
        stages = Stages(spark, "test")
        rows = R.stored(R.damage(df), stages)
        assert rows.select(F.shiftright("at", 33)).distinct().count() > 4
        (got,) = R.digest(df).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    assert tuple(got) == repaired(1000, [r[1:] for r in table if r[0] == 1000])


def test_repair_gives_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Still."), (1, 2, "assistant", ""), (2, 0, "system", "Sys."), (2, 1, "user", "Q")]
    out = R.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    got = {(r["conv_id"], r["turn"]): (r["fault"], r["edits"]) for r in out}
    assert got == {(1, 0): ("", "K"), (1, 1): ("", "R"), (1, 2): ("blank", "D"), (2, 0): ("", "K"), (2, 1): ("truncated", "KI")}


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert R.digest(none).count() == 0 and R.repair(none).count() == 0
