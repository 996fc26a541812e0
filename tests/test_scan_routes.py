"""Per-file routing (S4), and one parse rule at every split size."""

import random

import pytest
from pyspark.sql import functions as F

from bronzegate import schemas as S
from bronzegate.sources import quotes as Q
from bronzegate.sources.discover import detect_incoming
from bronzegate.sources.scan import _quoted_files, file_stats, route_files, scan_all

SPLIT_CONF = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


@pytest.fixture(params=["128m", "16"])
def split(spark, request):
    """Ordinary splits, and splits of sixteen bytes."""
    before = {k: spark.conf.get(k) for k in SPLIT_CONF}
    spark.conf.set(SPLIT_CONF[0], request.param)
    if request.param == "16":
        spark.conf.set(SPLIT_CONF[1], "0")
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def parsed(text, sep="|"):
    """(records, whether a quote stays open) by a character-at-a-time machine."""
    records, now, at, field = [], [], "begin", ""

    def end(record=False):
        nonlocal field, at, now
        now.append(field)
        field, at = "", "begin"
        if record:
            records.append(now)
            now = []

    for i, c in enumerate(text):
        if at == "inside":
            at, field = ("closing", field) if c == '"' else (at, field + c)
        elif at == "closing" and c == '"':
            at, field = "inside", field + c
        elif c == sep or c == "\n":
            end(c == "\n")
        elif c == "\r" and text[i + 1 : i + 2] in ("\n", ""):
            pass
        elif c == '"' and at == "begin":
            at = "inside"
        else:
            at, field = "text", field + c
    opened = at == "inside"
    if now or field or at != "begin":
        end(True)
    return records, opened


def test_records_equal_a_plain_parser(spark, tmp_path, split):
    rng = random.Random(1)
    pieces = ["a", "b c", '"', '""', "|", "|", "\n", "\r\n", "é", '"x"', '|"', '"|', '5" pipe']
    texts = {f"f{k:03d}.csv": "".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) + "\n" * (k % 3 > 0) for k in range(40)}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    placed, ends = Q.states(Q.with_effects(Q.read_lines(spark, [str(tmp_path)])))
    opened = {r["FILE_NAME"]: r["unclosed"] for r in ends.collect()}
    got = {}
    for r in Q.records(placed).withColumn("f", Q.fields(F.col("value"))).orderBy("FILE_NAME", "rec_blk", "rec_mid").collect():
        got.setdefault(r["FILE_NAME"], []).append(r["f"])
    blank = lambda r: len(r) == 1 and not r[0].strip(" \r\n\t")
    for name, text in texts.items():
        records, unclosed = parsed(text)
        assert opened.get(name, False) == unclosed, text
        if not unclosed:
            assert [r for r in got.get(name, []) if not blank(r)] == [r for r in records if not blank(r)], text


def test_routes(spark, tmp_path, split):
    d = tmp_path / "raw"
    d.mkdir()
    files = {
        "A": "a|b|c\n1|2|3\n4|5|6\n",              # strict
        "B": 'a|b|c\n1|"x\ny"|3\n',                # quoted newline
        "C": "a|b|c\n1|2|3|4\n",                    # long row
        "D": 'a|b|c\n1|"open|3\n',                  # unclosed quote
        "E": "",                                       # zero bytes
        "F": 'a|b|c\n1|"q|uo""ted"|3\n2\n',        # quotes, short row
        "G": 'a|b|c\n1|5" pipe|3\n',                # stray quote
        "H": 'a|b|c\n1|"x\ny"|3|4\n',              # long record over two lines
    }
    for tag, text in files.items():
        (d / f"EXT_MDSAssessmentExtract{tag}_Ontario_2024-01-05.csv").write_text(text)
    m = detect_incoming(spark, str(d))
    effects = Q.with_effects(Q.read_lines(spark, [str(d)]))
    stats = file_stats(effects)
    quoted = _quoted_files(effects, stats)
    got = {r.FILE_NAME[24]: r.route for r in route_files(m, stats, quoted).collect()}
    assert got == {"A": "strict", "B": "strict", "C": "tolerant", "D": "tolerant", "E": "unreadable", "F": "strict",
                   "G": "strict", "H": "tolerant"}


def test_headers_bind_by_row(spark, tmp_path, split):
    """Files with their own header order, extras and repeats are read in one pass, by name."""
    names = S.QUESTIONS_STRING_COLUMNS + S.QUESTIONS_DATE_COLUMNS
    orders = [names, names[::-1] + ["Extra"], ["extra", *names, "Unit"], names[1:] + names[:1] + ["INSTANCE", "unit"]]
    for i, head in enumerate(orders):
        rows = [[f"{c}-{i}-{k}" for c in head] for k in range(3)]
        rows[1][2] = '"two\nlines|and ""more"""'
        rows[2][2] = "NA"
        text = "\n".join("|".join(r) for r in [head, *rows]) + "\n"
        (tmp_path / f"EXT_MDSAssessmentExtract{i}_Ontario_2024-01-05.csv").write_text(text)
    (tmp_path / "other.csv").write_text("a|b\nnot|me\n")
    m = detect_incoming(spark, str(tmp_path))
    for glob in (None, f"{tmp_path}/*MDSAssessment*.csv"):
        rows = scan_all(spark, m, source_glob=glob)[S.QUESTIONS].rows
        assert rows.columns == ["FILE_NAME", *names, "extra", "Unit.1"]
        got = sorted(tuple("" if v is None else v for v in r) for r in rows.collect())
        want = []
        for i, head in enumerate(orders):
            for k in range(3):
                row = {c: f"{c}-{i}-{k}" for c in reversed(head)}
                row[head[2]] = ["two\nlines|and \"more\"", None][k - 1] if k else row[head[2]]
                row["Unit.1"] = row["Unit"] if i == 2 else None
                extra = row.get("Extra") or row.get("extra")
                want.append(tuple("" if v is None else v for v in (f"EXT_MDSAssessmentExtract{i}_Ontario_2024-01-05.csv", *(row[c] for c in names), extra, row["Unit.1"])))
        assert got == sorted(want)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "MDSAssessmentExtract0" not in plan  # no file name is a literal
