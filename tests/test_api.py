"""The familiar entry points work on Spark."""

import os

from bronzegate import api
from bronzegate import schemas as S

from test_landing import pair, q_row, s_row


def test_manual_parse_and_tarball(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text('a|b\n 1|"2"|3 \n4\n')
    rows = sorted(tuple(r) for r in api.manual_parse(spark, str(p)).collect())
    assert rows == [("1", "2"), ("4", None)]
    out = api.tarball_files(spark, [str(p)], str(tmp_path / "arc"), "bundle", "gzip")
    assert not p.exists() and spark.read.parquet(out).count() == 1


def test_raw_to_bronze_and_change_data(spark, tmp_path):
    data = tmp_path / "data"
    raw = data / "0-raw"
    raw.mkdir(parents=True)
    pair(str(raw), "A", [q_row(aid="1")], [s_row(aid="1")])
    res = api.raw_to_bronze(spark, str(data))
    assert res.log.count() == 2
    feed = api.get_change_data(spark, os.path.join(str(data), "1-bronze", S.QUESTIONS), res.batch_id)
    assert feed.count() == 1 and feed.first()["_change_type"] == "insert"
    r = api.check_column_value_sets("UNIQUE_ASSESSMENT_ID",
                                    spark.read.parquet(os.path.join(str(data), "1-bronze", S.QUESTIONS)),
                                    spark.read.parquet(os.path.join(str(data), "1-bronze", S.SCORING)))
    assert r.rel == api.EQUAL
