"""Every registered query against its SQL counterpart on the small sample tables."""

import importlib
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from coverlake.checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def normal(rows):
    return sorted((tuple(None if v is None else repr(v + 0.0) if isinstance(v, float) else str(v) for v in r) for r in rows), key=str)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    frame = entry.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    cursor = duck.execute(entry.oracle_sql()[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]
    assert normal(frame.select(*columns).collect()) == normal([[r[i] for i in order] for r in cursor.fetchall()])


def test_entry_stands_without_the_training_data_folder(monkeypatch):
    for name in ("corpus_pipeline", "__spark_entry__"):
        monkeypatch.delitem(sys.modules, name, raising=False)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    alone = importlib.import_module("__spark_entry__")
    assert set(alone.queries()) == set(QUERIES) and set(alone.oracle_sql()) == set(QUERIES)
    monkeypatch.delitem(sys.modules, "__spark_entry__")


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_plans_have_no_pair_joins_and_prune_columns(spark):
    for name in ("agg_daily_premium_summary", "arrival_report", "entity_inference", "ledger_state", "violations_claims"):
        plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
    plan = entry.queries()["agg_daily_premium_summary"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_discount" not in plan and "l_quantity" in plan
