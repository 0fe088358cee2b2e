from datetime import date, datetime
from decimal import Decimal

import pytest

from tidemark.entities import DIMENSIONS, ENTITIES, dimension_schema
from tidemark.operators import consumption
from tidemark.operators.scd2 import scd2
from tidemark.operators.upsert import upsert
from tidemark.plans import reports
from tidemark.sources.tables import empty

T1 = datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def layers(spark, stage_frame):
    """Two restaurants (one without location), three orders, five items; order 3 has no delivery."""
    rows = {
        "location": [{"location_id": "1", "city": "Bonn", "state": "NRW"}],
        "customer": [{"customer_id": "1", "name": "Ada"}],
        "restaurant": [
            {"restaurant_id": "1", "name": "R", "cuisine_type": "Thai", "location_id": "1"},
            {"restaurant_id": "2", "name": "S", "cuisine_type": "Thai"},
        ],
        "menu": [{"menu_id": "1", "restaurant_id": "1", "item_name": "Soup"}],
        "delivery_agent": [
            {"delivery_agent_id": str(i), "name": "G", "vehicle_type": "Bike", "rating": "4.50"}
            for i in (1, 2)
        ],
        "customer_address": [{"address_id": "1", "customer_id": "1", "city": "Bonn"}],
        "orders": [
            {"order_id": "1", "customer_id": "1", "restaurant_id": "1", "order_date": "2024-01-30 23:59:00"},
            {"order_id": "2", "customer_id": "1", "restaurant_id": "1", "order_date": "2024-02-02 00:00:00"},
            {"order_id": "3", "customer_id": "1", "restaurant_id": "1", "order_date": "2024-02-01 10:00:00"},
            {"order_id": "4", "customer_id": "1", "restaurant_id": "2", "order_date": "2024-02-01 10:00:00"},
        ],
        "order_item": [
            {"order_item_id": str(i), "order_id": o, "menu_id": "1", "quantity": "1", "price": p, "subtotal": p}
            for i, o, p in (
                (1, "1", "10.00"),
                (2, "1", "5.00"),
                (3, "1", "0.01"),
                (4, "2", "7.00"),
                (5, "3", "9.00"),
                (6, "4", "9.00"),
            )
        ],
        "delivery": [
            {"delivery_id": "1", "order_id": "1", "delivery_agent_id": "1", "delivery_status": "Delivered"},
            {"delivery_id": "2", "order_id": "2", "delivery_agent_id": "2", "delivery_status": "Cancelled"},
            {"delivery_id": "4", "order_id": "4", "delivery_agent_id": "1", "delivery_status": "Delivered"},
        ],
    }
    clean = {
        n: upsert(empty(spark, e.clean_schema()), stage_frame(n, rows[n]), e, T1)[0].cache()
        for n, e in ENTITIES.items()
    }
    dims = {
        n: scd2(empty(spark, dimension_schema(d)), clean[d.entity], d, T1).cache()
        for n, d in DIMENSIONS.items()
    }
    dims["date_dim"] = consumption.date_dim(clean["orders"]).cache()
    return clean, dims, consumption.build_fact(clean, dims).cache()


def test_calendar_fills_gaps(layers):
    rows = layers[1]["date_dim"].orderBy("calendar_date").collect()
    assert [r.date_dim_sk for r in rows] == [20240130, 20240131, 20240201, 20240202]
    last = rows[-1]
    assert (last.calendar_date, last.year, last.month, last.day, last.day_name) == (
        date(2024, 2, 2), 2024, 2, 2, "Fri",
    )


def test_calendar_of_nothing_is_empty(spark):
    assert consumption.date_dim(empty(spark, ENTITIES["orders"].clean_schema())).count() == 0


def test_fact_rows(layers):
    clean, _, fact = layers
    # order 3 has no delivery, order 4's restaurant has no location
    assert sorted(r.order_item_id for r in fact.collect()) == [1, 2, 3, 4]
    assert fact.schema.fieldNames() == consumption.FACT_SCHEMA.fieldNames()
    assert fact.filter("order_item_id = 4").first().date_dim_sk == 20240202


def test_second_delivery_does_not_double_items(layers, spark):
    clean, dims, _ = layers
    extra = clean["delivery"].filter("delivery_id = 1").selectExpr(
        "delivery_sk + 100 AS delivery_sk", "99L AS delivery_id", "order_id", "2L AS delivery_agent_id",
        "'In Transit' AS delivery_status", "estimated_time", "created_dt", "modified_dt",
        "_stg_file_name", "_stg_load_ts", "_copy_ts",
    )
    fact = consumption.build_fact(clean | {"delivery": clean["delivery"].unionByName(extra)}, dims)
    rows = fact.filter("order_id = 1").collect()
    assert len(rows) == 3 and {r.delivery_status for r in rows} == {"In Transit"}


def test_fact_upsert_keeps_order_and_unmatched_rows(layers):
    fact = layers[2]
    later = fact.filter("order_item_id <> 4").selectExpr(
        *[c if c not in ("order_id", "subtotal") else f"CAST({c} + 1 AS {'bigint' if c == 'order_id' else 'decimal(10,2)'}) AS {c}"
          for c in fact.columns]
    )
    after = {r.order_item_id: r for r in consumption.upsert_fact(fact, later).collect()}
    assert sorted(after) == [1, 2, 3, 4]
    assert after[1].order_id == 1 and after[1].subtotal == Decimal("11.00")
    assert after[4].subtotal == Decimal("7.00")


def test_address_dim_overwrites_in_place(spark, layers):
    addresses = layers[0]["customer_address"]
    start = consumption.address_dim(empty(spark, consumption.ADDRESS_DIM_SCHEMA), addresses)
    moved = addresses.withColumns({"city": addresses.city.substr(1, 0)})
    after = consumption.address_dim(start, moved).collect()
    assert len(after) == 1 and after[0].city == ""
    assert after[0].customer_address_dim_sk == start.first().customer_address_dim_sk


def test_monthly_revenue_counts_an_order_once(layers):
    _, dims, fact = layers
    rows = [tuple(r) for r in reports.monthly_revenue(fact, dims["date_dim"]).collect()]
    assert rows == [
        (2024, 1, Decimal("15.01"), 1, Decimal("15.01")),
        (2024, 2, Decimal("7.00"), 1, Decimal("7.00")),
    ]


def test_no_orders_no_average(layers):
    _, dims, fact = layers
    no_order = fact.selectExpr(
        *[f"CAST(NULL AS bigint) AS {c}" if c == "order_id" else c for c in fact.columns]
    )
    rows = reports.monthly_revenue(no_order, dims["date_dim"]).collect()
    assert {(r.total_orders, r.avg_order_value) for r in rows} == {(0, None)}
    assert sum(r.total_revenue for r in rows) == Decimal("22.01")


def test_revenue_by_cuisine(layers):
    _, dims, fact = layers
    rows = [tuple(r) for r in reports.revenue_by_cuisine(fact, dims["restaurant_dim"]).collect()]
    assert rows == [("Thai", Decimal("22.01"), 2)]
    # facts of a version that is no longer current vanish until the fact is refreshed
    closed = dims["restaurant_dim"].selectExpr(
        *["false AS is_current" if c == "is_current" else c for c in dims["restaurant_dim"].columns]
    )
    assert reports.revenue_by_cuisine(fact, closed).count() == 0


def test_agents_alike_share_a_line(layers):
    _, dims, fact = layers
    rows = reports.delivery_performance(fact, dims["delivery_agent_dim"]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.agent_name, r.total_deliveries, r.delivered_count, r.cancelled_count) == ("G", 2, 1, 1)
    assert r.delivered_rate_pct == Decimal("50.0")
    assert reports.top_agents(reports.delivery_performance(fact, dims["delivery_agent_dim"]), 0).count() == 0


def test_daily_usage(spark):
    usage = spark.sql(
        "SELECT * FROM VALUES (timestamp_ntz'2024-01-01 10:00:00', 'a', 1.5), (timestamp_ntz'2024-01-01 23:00:00', 'a', 2.0),"
        " (timestamp_ntz'2024-01-02 00:00:00', 'a', 4.0), (timestamp_ntz'2024-01-02 00:00:00', 'b', 8.0) AS t(start_time, resource, amount)"
    )
    rows = [(str(r.usage_date), r.amount) for r in reports.daily_usage(usage, "a").collect()]
    assert rows == [("2024-01-02 00:00:00", Decimal("4.0")), ("2024-01-01 00:00:00", Decimal("3.5"))]


def test_row_counts(layers):
    clean, dims, fact = layers
    counts = {r.label: r.row_count for r in reports.clean_row_counts(clean).collect()}
    assert counts["order_item"] == 6 and counts["restaurant_null_dates"] == 2 and len(counts) == 10
    partly = fact.selectExpr(
        *[f"CASE WHEN order_item_id > 1 THEN {c} END AS {c}" if c == "delivery_agent_dim_sk" else c for c in fact.columns]
    )
    counts = {r.label: r.row_count for r in reports.consumption_row_counts(dims, partly).collect()}
    assert counts["order_item_fact_total"] == 4 and counts["order_item_fact_with_delivery"] == 3
