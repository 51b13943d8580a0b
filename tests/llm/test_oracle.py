"""The corpus queries that SQL can express against their DuckDB SQL on the smallest generated tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from ridepulse.llm import catalog
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_registered():
    assert set(catalog.QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES) and set(catalog.ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, duck, key):
    got = catalog.QUERIES[key](spark, SF_SMALL)
    want = duck.sql(catalog.ORACLE_SQL[key])
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(r) for r in got.select(*want.columns).collect()]
    assert sorted(rows, key=repr) == sorted(want.fetchall(), key=repr) and rows
