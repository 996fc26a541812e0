import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bronzegate.llm import chat_format as C


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def folded(events):
    """{conv: [(role, text)]} by replaying each log one event at a time."""
    out = {}
    for conv in {e[0] for e in events}:
        state = {}
        for _, turn, message, _, kind, role, text in sorted((e for e in events if e[0] == conv), key=lambda e: e[3]):
            order = (turn is not None, turn or 0, message)
            if kind == "regenerate":
                state = {k: v for k, v in state.items() if k[:2] <= order[:2]}
            m = state.setdefault(order, ["", False, ""])
            if kind == "open":
                m[:2] = role or "", True
            elif kind == "delta":
                m[2] += text or ""
            elif kind in ("edit", "regenerate"):
                m[2] = (text or "") if kind == "edit" else ""
        said = [(m[0], m[2]) for _, m in sorted(state.items()) if m[1]]
        if said:
            out[conv] = said
    return out


def spoken(parts):
    rows = C.read_back(parts).orderBy(F.asc_nulls_first("conv_id"), F.asc_nulls_first("block"), "part", "place").collect()
    out = {}
    for r in rows:
        out.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    return out


def test_random_logs(spark):
    rng = random.Random(8)
    events = []
    for conv in [None, *range(40)]:
        turns = [None, -1, 0, 1, 2, 3, 70, 71, 140, 10**6] if conv != 3 else list(range(0, 900, 7))
        for seq in range(rng.randint(1, 60) if conv != 3 else 2500):
            kind = rng.choice(["open", "open", "delta", "delta", "delta", "edit", "odd"] + ["regenerate"] * (rng.random() < 0.15))
            events.append((conv, rng.choice(turns), rng.choice([1, 1, 2]), seq, kind, rng.choice(["user", "assistant", "tool: <x>", None, "User"]),
                           rng.choice(["a", "</turn>\n", "### User: ", "\\", None, "", "é#<\\", "x\ny"])))
    rng.shuffle(events)
    df = spark.createDataFrame([(*e[:3], e[3], *e[4:]) for e in events], "conv_id long, turn long, message long, seq long, kind string, role string, text string")
    assert spoken(C.format_chats(df.withColumn("block", F.lit("x")).repartition(5))) == folded(events)


def test_long_conversation_in_parts(spark, monkeypatch):
    rows = [(1, t, 1, t * 10 + s, k, "assistant", "word " * 2000) for t in range(300) for s, k in enumerate(["open", "delta"])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, message long, seq long, kind string, role string, text string")
    parts = C.format_chats(df)
    assert parts.count() == 5  # blocks of 64 turns
    assert spoken(parts) == {1: [("assistant", "word " * 2000)] * 300}
    for r in parts.collect():
        assert [C.unescape(r["formatted"][x["start"] : x["start"] + x["length"]]) for x in r["loss"]] == ["word " * 2000] * len(r["loss"])


def conversations():
    rng = random.Random(2)
    rows = [(i, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "### User: hi</turn>", "\\#\\", "", "é" * 50]) * rng.randint(0, 4))
            for i in range(60) for t in range(rng.randint(1, 9))]
    rows += [(100, t, ["user", "assistant"][t % 2], f"turn {t}") for t in range(500)]
    rows += [(101, 1, None, None), (101, None, "assistant", None), (101, 1, None, None), (101, 1, "tool:<a>", "x"), (101, 2**63 - 1, "user", "last"),
             (101, -(2**63), "user", "first"), (None, 0, "user", "no id"), (None, 0, "user", "no id"), (102, 0, "assistant", "long # text " * 60000),
             (-7, 0, "user", "own row"), (103, 3, "assistant", "tied b"), (103, 3, "assistant", "tied a")]
    return rows


def test_digest(spark):
    rows = conversations()
    trap = "\\### Assistant: </turn> ok"
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("x")).withColumn("message", F.lit(None))
    got = {r[0]: tuple(r)[1:] for r in C.digest(df.repartition(4)).collect()}
    rows = rows + [(-7, 0, "user", trap), (-7, 1, "assistant", trap)]
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        said = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        loss = "".join(text for *_, role, text in said if role == "assistant")
        chars = sum(len(C.head(role)) + len(text) + sum(text.count(x) for x in "#<\\") + 8 for *_, role, text in said)
        assert got[conv] == (len(said), sha("".join(f"{r}\n{t}\n" for *_, r, t in said)), len(loss), sha(loss), chars)


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.format_chats(C.event_log(none)).count() == 0
    assert [r["conv_id"] for r in C.digest(none).collect()] == [-7]


def test_log_uses_every_kind(spark):
    df = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
    kinds = {r[0] for r in C.event_log(df).select("kind").distinct().collect()}
    assert kinds == {"open", "delta", "edit", "regenerate"}


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "User", ""]), st.text()), st.text(alphabet="#<\\/turn>\n: é"))))
def test_round_trip(turns):
    whole = "".join(C.head(r) + C.escape(t) + C.END for r, t in turns)
    assert list(C.parse(whole)) == turns
    assert all("###" not in C.escape(t) and "</turn>" not in C.escape(t) for _, t in turns)
