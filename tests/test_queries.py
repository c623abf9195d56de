"""Every registered query against its DuckDB oracle on sf0.001 (the same
check the driver runs at sf0.01): columns, row count, values."""
import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from obsengine.plans import oracle, queries
from obsengine.sources.tables import TABLES

QUERIES = queries.REGISTRY
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.12g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    want = _rows(cols, res.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["airline_iata", "total_flights", "delayed_flights", "delay_rate",
                          "average_delay_minutes"]
    assert df.count() > 0
