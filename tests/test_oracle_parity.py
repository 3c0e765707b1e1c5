"""Every registered query equals its DuckDB SQL twin on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from holecard.plans import oracle, queries
from holecard.plans.standins import TABLES

from conftest import SMOKE_DIR

QUERIES = queries.QUERIES
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMOKE_DIR)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(SQL[name])
    cols = [c[0] for c in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, want)


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 3
    assert {r["prompt_type"] for r in rows} == {"lines", "tokens", "methods"}
