"""Every catalogue query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from corpusmill.plans import catalog

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, dict):
        return {k: norm(x) for k, x in v.items()}
    return [norm(x) for x in v] if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr(norm(tuple(r[c] for c in cols))) for r in df.collect())
    if name not in catalog.ORACLE_SQL:
        assert got
        return
    out = duck.execute(catalog.ORACLE_SQL[name])
    names = [x[0] for x in out.description]
    assert sorted(names) == cols
    want = sorted(repr(norm(tuple(r[names.index(c)] for c in cols))) for r in out.fetchall())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
