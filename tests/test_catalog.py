"""Every catalogued query against its DuckDB SQL on the driver tables (sf0.001), plus the
entry-point contract. Same comparison as the driver's correctness gate: column names,
row count and order-insensitive values."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TIDEWATER_TEST_SF", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    yield con
    con.close()


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(s_rows) >= 0
        return
    res = duck.execute(sql)
    d_cols = [c[0] for c in res.description]
    assert sorted(s_cols) == sorted(d_cols)
    assert _rows(s_cols, s_rows) == _rows(d_cols, res.fetchall())
