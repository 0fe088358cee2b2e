"""Rows against the version that was valid at their time, next to a plain reading of the rule."""

import random
import re
from datetime import datetime, timedelta

import pytest

from tidemark.entities import DIMENSIONS, ENTITIES
from tidemark.operators import consumption
from tidemark.operators.as_of import as_of
from tidemark.operators.numbering import number_rows
from tidemark.operators.scd2 import scd2
from tidemark.operators.clean import type_rows
from tidemark.sources.tables import empty
from tidemark.entities import dimension_schema

START = datetime(2024, 1, 1)
VERSIONS = "k long, eff_start_date timestamp_ntz, eff_end_date timestamp_ntz, v long"


def hours(n):
    return None if n is None else START + timedelta(hours=n)


def frames(spark, versions, rows):
    held = spark.createDataFrame([(k, hours(a), hours(b), v) for k, a, b, v in versions], VERSIONS)
    asked = spark.createDataFrame([(i, k, hours(t)) for i, (k, t) in enumerate(rows)], "i long, k long, t timestamp_ntz")
    return asked, held


def expected(versions, k, t, early):
    if k is None or t is None:
        return None
    mine = sorted((a, v, b) for key, a, b, v in versions if key == k and a is not None)
    begun = [m for m in mine if m[0] <= t]
    if not begun:
        return mine[0][1] if early and mine else None
    # of several that begin together the one with the greatest (end, columns) counts; no end is the least
    last = max(((m[0], m[2] if m[2] is not None else -1, m[1]) for m in begun))
    return None if last[1] >= 0 and t >= last[1] else last[2]


@pytest.mark.parametrize("early", [False, True])
@pytest.mark.parametrize("days", [1, 400])
def test_equals_the_plain_rule(spark, early, days):
    rng = random.Random(days)
    versions, number = [], 0
    for k in range(6):
        at = rng.randrange(200)
        for _ in range(rng.randrange(0, 30)):
            long = rng.randrange(1, 60)
            number += 1
            versions.append((k, at, rng.choice([None, at + long, at + long // 2 + 1]), number))
            at += long
    versions += [(9, 50, None, 1001), (9, 50, None, 1002), (None, 3, None, 1003), (8, None, None, 1004)]
    rows = [(rng.randrange(10), rng.randrange(1500)) for _ in range(400)]
    rows += [(9, 50), (9, 49), (None, 60), (3, None)] + [(k, a) for k, a, _, _ in versions if k is not None and a]
    asked, held = frames(spark, versions, rows)
    got = as_of(asked, held, "k", "t", ["v"], early=early, how="left", slice_days=days)
    assert got.columns == ["i", "k", "t", "v"]
    assert {r.i: r.v for r in got.collect()} == {i: expected(versions, k, t, early) for i, (k, t) in enumerate(rows)}
    kept = as_of(asked, held, "k", "t", ["v"], early=early, slice_days=days)
    assert kept.count() == sum(expected(versions, k, t, early) is not None for k, t in rows)


def test_without_versions_or_rows(spark):
    asked, held = frames(spark, [(1, 0, None, 1)], [(1, 5)])
    assert as_of(asked, held.limit(0), "k", "t", ["v"]).count() == 0
    assert as_of(asked.limit(0), held, "k", "t", ["v"]).count() == 0


def test_a_hot_key_is_spread_over_slices_and_no_pairs_are_made(spark):
    rows = spark.range(0, 60000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, id) AS t"
    )
    versions = spark.range(0, 20000, 1, 4).selectExpr(
        "7L AS k", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 3 * id) AS eff_start_date", "id AS v"
    )
    found = as_of(rows, versions, "k", "t", ["v"], until=None, slice_days=1)
    # Row 3 i of key 7 is at minute 3 i; version i begins there. Row 7 is of key 7 as well.
    assert found.selectExpr("count(*)", "sum(v)").first() == (20001, sum(range(20000)) + 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    # The window over marks is by key and slice; that by key alone sees one row per slice.
    assert re.search(r"last\(_version#\d+, true\) windowspecdefinition\(_key#\w+, _slice#\w+,", plan)
    assert re.search(r"last\(_last#\d+, true\) windowspecdefinition\(_key#\w+, _slice#\w+ ASC", plan)


def test_fact_takes_the_versions_of_the_order_time(spark, stage_frame):
    stage = {
        "location": [{"location_id": "1", "city": "Bonn", "state": "NRW"}, {"location_id": "2", "city": "Ulm", "state": "BW"}],
        "customer": [{"customer_id": "1", "name": "Ada"}],
        "restaurant": [{"restaurant_id": "1", "name": "R", "location_id": "1"}],
        "menu": [{"menu_id": "1", "restaurant_id": "1", "item_name": "Soup", "price": "1"}],
        "delivery_agent": [{"delivery_agent_id": "1", "name": "G"}],
        "orders": [
            {"order_id": str(i), "customer_id": "1", "restaurant_id": "1", "order_date": f"2024-0{i}-15 10:00:00"}
            for i in (1, 2, 3)
        ],
        "order_item": [
            {"order_item_id": str(i), "order_id": str(i), "menu_id": "1", "quantity": "1", "subtotal": "1"} for i in (1, 2, 3)
        ],
        "delivery": [{"delivery_id": str(i), "order_id": str(i), "delivery_agent_id": "1"} for i in (1, 2, 3)],
    }

    def clean(name, rows):
        spec = ENTITIES[name]
        return number_rows(type_rows(stage_frame(name, rows), spec), spec.key, spec.surrogate)

    later = {
        "restaurant": [{"restaurant_id": "1", "name": "R", "location_id": "2"}],
        "menu": [{"menu_id": "1", "restaurant_id": "1", "item_name": "Soup", "price": "2"}],
    }
    dims = {}
    for name, dim in DIMENSIONS.items():
        table = empty(spark, dimension_schema(dim))
        for rows, ts in ((stage[dim.entity], datetime(2024, 2, 1)), (later.get(dim.entity, stage[dim.entity]), datetime(2024, 3, 1))):
            table = scd2(table, clean(dim.entity, rows), dim, ts)
        dims[name] = table.cache()
    tables = {n: clean(n, stage[n]) for n in ("orders", "order_item", "delivery")}
    dims["date_dim"] = consumption.date_dim(tables["orders"])
    fact = consumption.build_fact_as_of(tables, dims)
    assert fact.schema.fieldNames() == consumption.FACT_SCHEMA.fieldNames()
    joined = fact.join(dims["menu_dim"].select("menu_dim_sk", "price").withColumnRenamed("price", "at"), "menu_dim_sk")
    joined = joined.join(dims["location_dim"].select("location_dim_sk", "city"), "location_dim_sk")
    got = {r.order_id: (int(r["at"]), r.city) for r in joined.collect()}
    # January's order is from before all versions, and points to the first ones.
    assert got == {1: (1, "Bonn"), 2: (1, "Bonn"), 3: (2, "Ulm")}
    strict = consumption.build_fact_as_of(tables, dims, early=False)
    assert sorted(r.order_id for r in strict.collect()) == [2, 3]
