import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from keelson.plans.jobs import CALC_SCHEMA
from keelson.plans.registry import QUERIES, oracle

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.schema == CALC_SCHEMA
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _canon(rows):
    return sorted((tuple((x is None, repr(x)) for x in r) for r in rows))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    spark_rows = [tuple(r[c] for c in sorted(cols)) for r in df.collect()]
    idx = [cols.index(c) for c in sorted(cols)]
    duck_rows = [tuple(r[i] for i in idx) for r in res.fetchall()]
    assert _canon(spark_rows) == _canon(duck_rows)
