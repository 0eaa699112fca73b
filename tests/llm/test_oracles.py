import duckdb
import pytest

from conftest import SF001
from keelson.llm.queries import ORACLE_SQL, QUERIES

TABLES = "documents embeddings pages conversations"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = QUERIES[name](spark, SF001)
    res = con.execute(ORACLE_SQL[name])
    columns = sorted(d[0] for d in res.description)
    at = [[d[0] for d in res.description].index(c) for c in columns]
    assert sorted(got.columns) == columns
    key = lambda r: tuple((x is None, repr(x)) for x in r)
    want = sorted((tuple(r[i] for i in at) for r in res.fetchall()), key=key)
    have = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=key)
    assert len(have) == len(want)
    assert have == want
