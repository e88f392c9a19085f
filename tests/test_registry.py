"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from starquill.bindings import registry
from tools.check import rows_of

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_entry_has_every_query():
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, sf_dir, duck, key):
    df = QUERIES[key](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in plan
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if key in ORACLES:
        result = duck.execute(ORACLES[key])
        columns = [c[0] for c in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == rows_of(columns, result.fetchall())
    else:
        assert got


def test_entry(spark):
    assert entry.entry(spark).count() == 3
