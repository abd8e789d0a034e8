"""Every query against its DuckDB statement on the sample tables."""

from __future__ import annotations

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from auditweave.plans.registry import PLANS

SF_DIR = os.environ.get("AUDIT_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
QUERIES = {name: query for name, query in entry.queries().items() if name in PLANS}
STATEMENTS = {name: text for name, text in entry.oracle_sql().items() if name in PLANS}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield con
    con.close()


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        tuple(str(r[i]) if isinstance(r[i], Decimal) else repr(r[i]) for i in order)
        for r in rows
    )


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS) == set(PLANS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_statement(name, spark, duck):
    result = QUERIES[name](spark, SF_DIR)
    relation = duck.sql(STATEMENTS[name])
    ours = [c.lower() for c in result.columns]
    theirs = [c.lower() for c in relation.columns]
    assert sorted(ours) == sorted(theirs)
    rows = _sorted_rows(ours, result.collect())
    assert rows, "the sample tables must exercise the query"
    assert rows == _sorted_rows(theirs, relation.fetchall())


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_compares_no_all_pairs(name, spark):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
