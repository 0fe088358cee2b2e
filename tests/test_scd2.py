from datetime import date, datetime
from decimal import Decimal

import pytest

from tidemark.entities import DIMENSIONS, ENTITIES, dimension_schema
from tidemark.operators.scd2 import scd2
from tidemark.sources.tables import empty

TIMES = [datetime(2024, 3, d) for d in (1, 2, 3, 4)]


def source(spark, entity, rows):
    schema = ENTITIES[entity].clean_schema()
    full = [
        tuple(({ENTITIES[entity].surrogate: i + 1} | r).get(n) for n in schema.fieldNames())
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(full, schema)


def run(spark, dim_name, batches, **options):
    dim = DIMENSIONS[dim_name]
    table = empty(spark, dimension_schema(dim))
    for ts, rows in zip(TIMES, batches):
        table = scd2(table, source(spark, dim.entity, rows), dim, ts, **options).cache()
    check_invariants(table, dim)
    return table


def check_invariants(table, dim):
    rows = [r.asDict() for r in table.collect()]
    numbers = [r[dim.surrogate] for r in rows]
    assert len(set(numbers)) == len(numbers)
    per_key = {}
    for r in rows:
        per_key.setdefault(r[ENTITIES[dim.entity].key], []).append(r)
    for versions in per_key.values():
        versions.sort(key=lambda r: r["eff_start_date"])
        assert [v["is_current"] for v in versions] == [False] * (len(versions) - 1) + [True]
        for earlier, later in zip(versions, versions[1:]):
            assert earlier["eff_end_date"] == later["eff_start_date"]
        assert versions[-1]["eff_end_date"] is None


LOCATION = {"location_id": 1, "city": "Bonn", "state": "NRW", "zipcode": "1", "active_flag": True}


def versions(table):
    return sorted((r.eff_start_date, r.eff_end_date, r.is_current) for r in table.collect())


def test_new_changed_unchanged_and_third_batch(spark):
    moved = LOCATION | {"zipcode": "2"}
    other = LOCATION | {"location_id": 2}
    table = run(spark, "location_dim", [[LOCATION], [moved, other], [moved, other], [LOCATION, other]])
    one = table.filter("location_id = 1")
    assert versions(one) == [
        (TIMES[0], TIMES[1], False),
        (TIMES[1], TIMES[3], False),
        (TIMES[3], None, True),
    ]
    assert versions(table.filter("location_id = 2")) == [(TIMES[1], None, True)]


def test_null_on_a_plain_column_is_no_change(spark):
    table = run(spark, "location_dim", [[LOCATION | {"active_flag": None}], [LOCATION]])
    assert table.count() == 1
    safe = run(spark, "location_dim", [[LOCATION | {"active_flag": None}], [LOCATION]], null_safe=True)
    assert safe.count() == 2


def test_null_next_to_a_real_change_does_not_hide_it(spark):
    table = run(
        spark, "location_dim", [[LOCATION | {"active_flag": None}], [LOCATION | {"city": "Köln"}]]
    )
    assert table.count() == 2


def test_null_to_value_on_a_stand_in_column(spark):
    assert run(spark, "location_dim", [[LOCATION | {"zipcode": None}], [LOCATION]]).count() == 2
    # the stand-in itself equals NULL
    assert run(spark, "location_dim", [[LOCATION | {"zipcode": None}], [LOCATION | {"zipcode": ""}]]).count() == 1


@pytest.mark.parametrize(
    "dim, row, change, versions_after",
    [
        ("customer_dim", {"customer_id": 1, "name": "A"}, {"dob": date(1900, 1, 1)}, 1),
        ("customer_dim", {"customer_id": 1, "name": "A"}, {"dob": date(1980, 1, 1)}, 2),
        ("customer_dim", {"customer_id": 1, "name": "A"}, {"gender": "Other"}, 2),
        ("restaurant_dim", {"restaurant_id": 1, "name": "R"}, {"pricing_for_two": Decimal("0.00")}, 1),
        ("restaurant_dim", {"restaurant_id": 1, "name": "R"}, {"pricing_for_two": Decimal("9.50")}, 2),
        ("restaurant_dim", {"restaurant_id": 1, "name": "R"}, {"operating_hours": "x"}, 1),
        ("restaurant_dim", {"restaurant_id": 1, "name": "R"}, {"location_id": 4}, 1),
        ("restaurant_dim", {"restaurant_id": 1, "name": "R", "location_id": 3}, {"location_id": 4}, 2),
        ("menu_dim", {"menu_id": 1, "item_name": "Soup"}, {"item_name": "Stew", "restaurant_id": 9}, 1),
        ("menu_dim", {"menu_id": 1, "item_name": "Soup"}, {"price": Decimal("3.00")}, 2),
        ("delivery_agent_dim", {"delivery_agent_id": 1, "name": "A"}, {"name": "B", "vehicle_type": "Car"}, 1),
        ("delivery_agent_dim", {"delivery_agent_id": 1, "name": "A"}, {"rating": Decimal("4.00")}, 2),
    ],
)
def test_what_opens_a_version(spark, dim, row, change, versions_after):
    assert run(spark, dim, [[row], [row | change]]).count() == versions_after


def test_untracked_change_stays_stale_until_a_tracked_one(spark):
    soup = {"menu_id": 1, "item_name": "Soup", "price": Decimal("1.00")}
    renamed = soup | {"item_name": "Stew"}
    table = run(spark, "menu_dim", [[soup], [renamed]])
    assert table.first().item_name == "Soup"
    table = run(spark, "menu_dim", [[soup], [renamed], [renamed | {"price": Decimal("2.00")}]])
    assert table.filter("is_current").first().item_name == "Stew"


def test_key_missing_from_the_source_stays_current(spark):
    other = LOCATION | {"location_id": 2}
    table = run(spark, "location_dim", [[LOCATION, other], [LOCATION]])
    assert table.filter("location_id = 2 AND is_current").count() == 1


def test_same_batch_again_changes_nothing(spark):
    table = run(spark, "location_dim", [[LOCATION], [LOCATION]])
    assert versions(table) == [(TIMES[0], None, True)]
