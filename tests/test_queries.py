"""Every query with SQL agrees with DuckDB on the smallest tables; the others run and keep their schema."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return tuple(map(norm, v)) if isinstance(v, list) else v


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_only_for_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name in SQL:
        con = duckdb.connect()
        for t in os.listdir(sf):
            con.sql(f"create view {t.removesuffix('.parquet')} as select * from '{sf}/{t}'")
        r = con.sql(SQL[name])
        assert sorted(r.columns) == cols
        want = sorted((tuple(norm(dict(zip(r.columns, x))[c]) for c in cols) for x in r.fetchall()), key=repr)
        assert got == want
