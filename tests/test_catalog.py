"""Every catalogued query runs on the sf0.001 tables and agrees with its SQL oracle."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "customer", "nation", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 25
    assert "rank_slowest" in df.columns


def test_every_query_has_oracle_or_is_documented():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert set(E.QUERIES) - set(sql) == set(E.NO_ORACLE)


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(E.QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, cur.fetchall())
