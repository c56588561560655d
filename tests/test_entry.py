"""Every registered query against its SQL in DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from lattica import queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables here")
@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_matches_sql(spark, duck, name):
    df = queries.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(queries.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(shown(r[names.index(c)]) for c in cols) for r in cur.fetchall())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables here")
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
