"""Every registered query against its DuckDB oracle on the smallest tables:
same columns, same row count, same values (order-insensitive)."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
from mediapanel.plans.registry import ORACLE as OWN_ORACLE  # noqa: E402
from mediapanel.plans.registry import QUERIES as OWN  # noqa: E402

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    """But for operators that SQL cannot express, which have tests of their own."""
    assert set(OWN) == set(OWN_ORACLE) and set(OWN) <= set(QUERIES)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF).toPandas()
    odf = con.execute(ORACLE[name]).fetchdf()
    c1, r1 = rows_of(sdf)
    c2, r2 = rows_of(odf)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["date_local", "market", "channel"]
    assert df.count() > 0
