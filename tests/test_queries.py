from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from bindings import merge_queries
from bindings.registry import ORACLES, QUERIES
from check_oracle import TABLES, compare
from lithic.sources.tables import TableStore

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the test tables are not here")

# Nodes that run Python per row, pair everything with everything, or pull a window into one task.
UNWANTED = r"BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, db, name):
    result = compare(spark, db, name, SF_DIR)
    assert result.startswith("ok"), result


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"warehouse_fact", "warehouse_rerun", "fact_load"}))
def test_plan(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(UNWANTED, plan), plan
    assert not re.search(r"Window \[[^\n]*\n(\s*[:+*|( )\-0-9]*(Sort|WindowGroupLimit|Filter|Project)[^\n]*\n)*[^\n]*SinglePartition", plan)


def test_every_query_has_sql_and_the_flagship_runs(spark):
    assert ORACLES.keys() == QUERIES.keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert entry.entry(spark).count() > 0


def test_rolled_up_sets_are_made_once(spark, monkeypatch):
    """Both batches of the daily sums read the sets as they were written, instead of cleaning and ranking them again."""
    plans, append = [], TableStore.append_fact
    monkeypatch.setattr(TableStore, "append_fact", lambda self, df, *a, **k: plans.append(df) or append(self, df, *a, **k))
    merge_queries.rolled_up(spark, SF_DIR)
    batches = [str(df._jdf.queryExecution().executedPlan()) for df in plans if "reps" in df.columns and "sets" not in df.columns]
    assert len(batches) == 2 and not any("Window" in plan or "Join" in plan for plan in batches)
