"""Every registered query runs at sf0.001 and matches its DuckDB oracle (when it has one)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from layerkit.plans import catalog
from layerkit.sources.tables import TABLES

from .conftest import SF001

NAMES = sorted(catalog.queries())


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) >= 0
        return
    res = duck.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _bag(df.columns, rows) == _bag(cols, res.fetchall())
