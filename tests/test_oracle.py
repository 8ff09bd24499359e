"""Every registered query equals its independent SQL (DuckDB) on sf0.001."""
import datetime as dt
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as se
from helpers import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, float):
        return repr(round(v, 6))
    return v


def _multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(se.oracle_sql()) <= set(se.queries())
    assert len(se.oracle_sql()) >= 30


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF001)
    s_cols = df.columns
    s = _multiset(s_cols, [tuple(r) for r in df.collect()])
    cur = duck.execute(se.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d = _multiset(d_cols, cur.fetchall())
    assert sorted(s_cols) == sorted(d_cols)
    assert sum(s.values()) == sum(d.values())
    assert s == d


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns
