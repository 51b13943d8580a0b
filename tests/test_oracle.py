"""Every registered query against its DuckDB SQL on the smallest generated tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from ridepulse.plans.catalog import QUERIES
from ridepulse.plans.oracle import ORACLE_SQL

TABLES = ["events", "lineitem"]


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    return (1, str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


def test_every_key_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[key])
    a_cols, a = _rows(df.columns, [tuple(r) for r in df.collect()])
    b_cols, b = _rows(rel.columns, rel.fetchall())
    assert a_cols == b_cols
    assert len(a) == len(b)
    assert a == b


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["hour", "total_trips", "avg_fare", "avg_distance"]
    assert df.count() > 0
