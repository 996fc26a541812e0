import duckdb
import pytest

from bronzegate.llm.oracles import ORACLES
from bronzegate.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    names = sorted(d[0] for d in want.description)
    order = [[d[0] for d in want.description].index(n) for n in names]
    want = sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
    got = sorted((tuple(r[n] for n in names) for r in QUERIES[name](spark, SF).collect()), key=repr)
    assert got == want
