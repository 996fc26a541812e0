import random

import pytest

from bronzegate.llm import passages, substring_dedup, suffix_dedup
from tests.llm import brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(5000)}"
    text = lambda n: [word() for _ in range(n)]
    docs = [text(rng.randint(1, 400)) for _ in range(60)]
    for size in (49, 50, 51, 60, 120):
        passage = text(size)
        for d in rng.sample(docs, 6):
            at = rng.randint(0, len(d))
            d[at:at] = passage
    common = text(30)  # a common short passage: many different surroundings of one place
    docs += [text(40) + common + text(40) for _ in range(40)]
    shared = text(55)
    docs += [text(30) + shared + text(rng.randint(0, 30)) for _ in range(30)]
    docs += [list(docs[3]) for _ in range(5)] + [["a"] * 130, ["a"] * 90, []]
    docs += [shared[:40] + common + docs[5][:60], docs[5][:60] + shared[10:]]
    rows = [(i, " ".join(d) if i % 7 else "\n".join(d) + "\t ") for i, d in enumerate(docs)] + [(900, None), (901, "  ")]
    frame = spark.createDataFrame([*rows, (None, rows[3][1]), (3, rows[3][1])], "doc_id long, text string")
    return frame.selectExpr("*", "1 as key", "'x' as words", "2 as id"), rows


def check_removed(frame, rows):
    want = {i: (n, n - len(kept), brute.sha(" ".join(kept))) for i, (n, kept) in brute.windows(rows).items()}
    got = {r[0]: tuple(r)[1:] for r in substring_dedup.digest(frame).collect() if r[0] is not None}
    assert got == want


def check_repeated(frame, rows):
    held = {}
    for i, t in rows:
        w = brute.words(t)
        for j in range(len(w) - 49):
            held.setdefault(tuple(w[j : j + 50]), set()).add(i)
    want = {}
    for i, t in rows:
        w = brute.words(t)
        for j in range(len(w) - 49):
            if len(held[tuple(w[j : j + 50])]) > 1:
                want.setdefault(i, set()).update(range(j, j + 50))
    got = {}
    for r in suffix_dedup.digest(frame).collect():
        assert r["other_doc_id"] != r["doc_id"] and r["n_words"] >= 50
        got.setdefault(r["doc_id"], set()).update(range(r["start"], r["start"] + r["n_words"]))
    assert got == want


@pytest.mark.parametrize("hot", [1, 256])
@pytest.mark.parametrize("check", [check_removed, check_repeated])
def test_planted(spark, planted, check, hot, monkeypatch):
    monkeypatch.setattr(passages, "HOT", hot)
    check(*planted)


@pytest.mark.parametrize("check", [check_removed, check_repeated])
def test_whole_table(spark, check):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    check(frame, [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()])


def test_empty(spark, planted):
    assert substring_dedup.digest(planted[0].limit(0)).count() == 0
    assert suffix_dedup.digest(planted[0].limit(0)).count() == 0


def test_windows_side_by_side_are_one_span(spark):
    rows = [(1, 1, at, 3, 9) for at in (4, 5, 6, 8)] + [(1, 1, 7, 3, 8), (1, 1, 5, 3, 9), (2, 1, 0, 3, 9)]
    windows = spark.createDataFrame(rows, "p1 long, p2 long, at long, first long, last long")
    got = sorted(map(tuple, suffix_dedup._spans(windows, 50).collect()))
    assert got == [(1, 1, 4, 56, 3, 9), (1, 1, 7, 57, 3, 8), (1, 1, 8, 58, 3, 9), (2, 1, 0, 50, 3, 9)]
