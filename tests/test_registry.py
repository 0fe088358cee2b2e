"""Registered queries: each has its SQL, and plans keep the shapes they are meant to have."""

import os
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as registered
from tidemark.entities import ENTITIES
from tidemark.operators.clean import last_per_key, type_rows
from tidemark.registry.oracle import all_oracles
from tidemark.registry.queries import all_queries

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="given tables not mounted")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_module_names_differ_between_test_folders():
    names = Counter(p.name for p in Path(__file__).parent.rglob("*.py") if p.name != "conftest.py")
    assert [n for n, count in names.items() if count > 1] == []


def test_every_query_has_sql():
    assert sorted(all_queries()) == sorted(all_oracles())
    assert set(all_queries()) <= set(registered.queries())


@needs_tables
def test_entry(spark):
    assert registered.entry(spark).columns == [
        "year", "month", "total_revenue", "total_orders", "avg_order_value",
    ]


@needs_tables
@pytest.mark.parametrize("name", ["clean_restaurant", "upsert_delivery", "scd2_menu", "daily_usage", "masked_customer",
     "stage_extracts", "stage_malformed", "upsert_two_files", "backfill_resent", "masked_customer_dim"])
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    duck = duckdb.connect()
    for file in os.listdir(SMALL):
        duck.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SMALL}/{file}'")
    df = registered.queries()[name](spark, SMALL)
    result = duck.execute(registered.oracle_sql()[name])
    names = [d[0] for d in result.description]
    want = [dict(zip(names, r)) for r in result.fetchall()]
    got = [r.asDict() for r in df.collect()]
    key = lambda r: repr(sorted(r.items()))
    assert sorted(got, key=key) == sorted(want, key=key)


@needs_tables
@pytest.mark.parametrize("name", ["monthly_revenue", "revenue_by_cuisine", "delivery_performance", "order_item_fact"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(registered.queries()[name](spark, SMALL))
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@needs_tables
def test_report_reads_only_what_it_needs(spark):
    text = plan(registered.queries()["monthly_revenue"](spark, SMALL))
    assert "l_extendedprice" in text
    assert "l_shipdate" not in text and "l_quantity" not in text and "o_totalprice" not in text


def test_last_per_key_limits_ahead_of_the_shuffle(stage_frame):
    entity = ENTITIES["customer"]
    text = plan(last_per_key(type_rows(stage_frame("customer", []), entity), entity.key))
    assert text.count("WindowGroupLimit") == 2
