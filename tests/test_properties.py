"""Brute-force cross-checks on small random inputs."""

import csv
import io
import os
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bronzegate import schemas as S
from bronzegate.operators.models import BOTH, EQUAL, LEFT_NOT_RIGHT, RIGHT_NOT_LEFT
from bronzegate.operators.quality import check_column_value_sets
from bronzegate.plans.landing import land
from bronzegate.sources import bronze as B

values = st.lists(st.one_of(st.none(), st.integers(-3, 6)), min_size=1, max_size=12)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values, values)
def test_value_sets_match_python_sets(spark, left, right):
    l = spark.createDataFrame([(v,) for v in left], "k bigint")
    r = spark.createDataFrame([(v,) for v in right], "k bigint")
    res = check_column_value_sets("k", l, r)
    ls, rs = set(left), set(right)
    expected = {(False, False): EQUAL, (True, False): LEFT_NOT_RIGHT,
                (False, True): RIGHT_NOT_LEFT, (True, True): BOTH}[(bool(ls - rs), bool(rs - ls))]
    assert res.rel == expected
    if res.lnotr is not None:
        key = lambda v: (v is None, v if v is not None else 0)
        assert sorted((x[0] for x in res.lnotr.collect()), key=key) == \
            sorted((v for v in left if v not in rs), key=key)


def test_strict_scan_matches_csv_module(spark, tmp_path):
    rng = random.Random(7)
    pieces = ["a", "b c", "|", '"', "x|y", "line\nbreak", " pad ", "é", "''", "z"]
    cols = S.QUESTIONS_STRING_COLUMNS
    rows = []
    for i in range(60):
        row = {c: "".join(rng.choice(pieces) for _ in range(rng.randint(1, 3))) for c in cols}
        row["Assessment ID"] = str(i)
        row["ARD"] = "2024-01-05 10:00:00"
        row["Answer_Date"] = ""
        rows.append(row)
    header = cols + S.QUESTIONS_DATE_COLUMNS
    buf = io.StringIO()
    w = csv.DictWriter(buf, fieldnames=header, delimiter="|", quotechar='"', quoting=csv.QUOTE_MINIMAL,
                       lineterminator="\n")
    w.writeheader()
    w.writerows(rows)
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "EXT_MDSAssessmentExtract_Ontario_2024-01-05.csv").write_text(buf.getvalue())
    s_header = "|".join(S.SCORING_STRING_COLUMNS + S.SCORING_FLOAT_COLUMNS + S.SCORING_DATE_COLUMNS)
    s_lines = ["|".join([r["Facility ID"].replace("|", "").replace('"', "").replace("\n", ""),
                         r["Resident ID"].replace("|", "").replace('"', "").replace("\n", ""),
                         "U", str(i), "S", "R"] + ["1"] * 14 + ["", "", "", ""]) for i, r in enumerate(rows)]
    (raw / "EXT_MDSAssessmentExtractScoring_Ontario_2024-01-05.csv").write_text(
        s_header + "\n" + "\n".join(s_lines) + "\n")
    bronze = str(tmp_path / "bronze")
    land(spark, str(raw), bronze)
    got = {r["Assessment ID"]: r for r in B.read_table(spark, B.table_path(bronze, S.QUESTIONS)).collect()}
    expect = list(csv.DictReader(io.StringIO(buf.getvalue()), delimiter="|", quotechar='"'))
    assert len(got) == len(expect) == 60
    for e in expect:
        g = got[e["Assessment ID"]]
        for c in cols:
            want = "" if e[c] in S.NA_TOKENS else e[c]
            assert g[c] == want, (c, e[c], g[c])
    log = {r["FILE_NAME"]: r for r in B.read_log(spark, bronze).collect()}
    q = log["EXT_MDSAssessmentExtract_Ontario_2024-01-05.csv"]
    assert q["READ_ERRORS"] == [] and q["N_ROWS"] == 60
    assert os.path.exists(raw / "EXT_MDSAssessmentExtract_Ontario_2024-01-05.csv")
