"""Every registered driver query against its DuckDB oracle (sf0.001)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from airtrace.plans.archive_queries import ARCHIVE_ORACLES, ARCHIVE_QUERIES
from airtrace.plans.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["day", "avg_aqi"] and df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(ARCHIVE_QUERIES) == set(ARCHIVE_ORACLES)
    assert {*QUERIES, *ARCHIVE_QUERIES} <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted({*QUERIES, *ARCHIVE_QUERIES}))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _rows(cols, res.fetchall())
