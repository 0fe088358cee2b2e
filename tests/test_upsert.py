from datetime import datetime

import pytest
from pyspark.sql import functions as F

from keyed_rows import by_key
from tidemark.entities import ENTITIES
from tidemark.operators.numbering import highest, number_rows
from tidemark.operators.clean import clean_rows
from tidemark.operators.upsert import RequiredValueMissing, backfill_dates, merge, numbered_new, upsert
from tidemark.sources.tables import empty

T1, T2 = datetime(2024, 3, 1), datetime(2024, 3, 2)
CUSTOMER = ENTITIES["customer"]


@pytest.fixture(scope="module")
def first(spark, stage_frame):
    stage = stage_frame(
        "customer",
        [
            {"customer_id": "1", "name": "Ada", "email": "a@x", "created_date": "NOT_A_DATE"},
            {"customer_id": "2", "name": "Bo", "email": "b@x"},
            {"customer_id": "3", "name": "Cy", "email": "c@x"},
        ],
    )
    table, _ = upsert(empty(spark, CUSTOMER.clean_schema()), stage, CUSTOMER, T1)
    return table.cache()


def test_insert_update_untouched(spark, stage_frame, first):
    stage = stage_frame(
        "customer",
        [
            {"customer_id": "1", "name": "Ada", "email": None},
            {"customer_id": "4", "name": "Di", "email": "d@x"},
        ],
        file="b.csv",
        copied="2024-03-02 00:00:00",
    )
    old = by_key(first, "customer_id")
    new = by_key(upsert(first, stage, CUSTOMER, T2)[0], "customer_id")
    assert sorted(new) == [1, 2, 3, 4]
    assert new[2] == old[2] and new[3] == old[3]
    # NULL overwrites; insert-only values stay, even a lost creation date
    assert new[1]["email"] is None
    assert new[1]["created_dt"] is None
    assert new[1]["_stg_file_name"] == "a.csv" and new[1]["_copy_ts"] == T1
    assert new[1]["customer_sk"] == old[1]["customer_sk"]
    assert new[4]["_stg_file_name"] == "b.csv" and new[4]["_copy_ts"] == T2
    assert new[4]["customer_sk"] > max(r["customer_sk"] for r in old.values())


def test_last_copy_of_a_key_wins(stage_frame, spark):
    older = stage_frame("customer", [{"customer_id": "1", "name": "old"}], file="z.csv")
    newer = stage_frame(
        "customer", [{"customer_id": "1.0", "name": "new"}], file="a.csv", copied="2024-03-01 00:00:01"
    )
    table, _ = upsert(
        empty(spark, CUSTOMER.clean_schema()), older.unionByName(newer), CUSTOMER, T1
    )
    assert [r.name for r in table.collect()] == ["new"]


def test_missing_required_values_are_set_aside(stage_frame, first):
    stage = stage_frame(
        "customer",
        [{"customer_id": "oops", "name": "No key"}, {"customer_id": "9"}, {"customer_id": None}],
    )
    table, rejects = upsert(first, stage, CUSTOMER, T2)
    assert table.count() == 3
    reasons = sorted(r.reject_reason for r in rejects.collect())
    assert reasons == ["missing: customer_id", "missing: customer_id,name", "missing: name"]
    with pytest.raises(RequiredValueMissing):
        upsert(first, stage, CUSTOMER, T2, strict=True)


def test_numbers_beyond_a_key_are_named(stage_frame, first):
    rows = [{"customer_id": str(2**63), "name": "Big"}, {"customer_id": "9" * 45 + ".5", "name": "Huge"}, {"customer_id": "1e", "name": "No"}]
    _, rejects = upsert(first, stage_frame("customer", rows), CUSTOMER, T2)
    reasons = sorted(r.reject_reason for r in rejects.collect())
    assert reasons == ["missing: customer_id", "out of range: customer_id", "out of range: customer_id"]


def test_of_two_files_copied_at_once_the_later_counts(stage_frame, spark):
    early = stage_frame("customer", [{"customer_id": "1", "name": "early"}], file="part_9.csv")
    late = stage_frame("customer", [{"customer_id": "1", "name": "late"}], file="part_10.csv")
    late = late.withColumn("_stg_load_ts", F.expr("_stg_load_ts + INTERVAL 3 DAYS"))
    table, _ = upsert(empty(spark, CUSTOMER.clean_schema()), early.unionByName(late), CUSTOMER, T1)
    assert [r.name for r in table.collect()] == ["late"]


def test_empty_batch_and_replay_change_nothing(stage_frame, first):
    before = by_key(first, "customer_id")
    nothing, _ = upsert(first, stage_frame("customer", []), CUSTOMER, T2)
    assert by_key(nothing, "customer_id") == before
    stage = stage_frame("customer", [{"customer_id": "2", "name": "Bo", "email": "new"}])
    once = upsert(first, stage, CUSTOMER, T2)[0].cache()
    twice, _ = upsert(once, stage, CUSTOMER, T2)
    assert by_key(twice, "customer_id") == by_key(once, "customer_id")


def test_delivery_keeps_its_order_and_agent(spark, stage_frame):
    delivery = ENTITIES["delivery"]
    row = {"delivery_id": "1", "order_id": "10", "delivery_agent_id": "5", "delivery_status": "In Transit"}
    table, _ = upsert(empty(spark, delivery.clean_schema()), stage_frame("delivery", [row]), delivery, T1)
    changed = row | {"order_id": "11", "delivery_agent_id": "6", "delivery_status": "Delivered"}
    after = upsert(table, stage_frame("delivery", [changed]), delivery, T2)[0].first()
    assert (after.order_id, after.delivery_agent_id, after.delivery_status) == (10, 5, "Delivered")


def test_merge_does_not_delete(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    source = spark.createDataFrame([(2, None), (3, "c")], "k long, v string")
    rows = sorted(tuple(r) for r in merge(target, source, "k", ("v",)).collect())
    assert rows == [(1, "a"), (2, None), (3, "c")]


def test_numbers_are_unique_and_repeatable(spark):
    rows = spark.range(5000).selectExpr("id * 3 AS k")
    one = {r.k: r.n for r in number_rows(rows, "k", "n", 100).collect()}
    two = {r.k: r.n for r in number_rows(rows.repartition(7), "k", "n", 100).collect()}
    assert one == two
    assert len(set(one.values())) == 5000 and min(one.values()) > 100


def test_numbers_do_not_depend_on_the_session(spark):
    rows = spark.range(500).selectExpr("id AS k")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for partitions in ("2", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        seen.append({r.k: r.n for r in number_rows(rows, "k", "n").collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


def test_only_new_keys_are_numbered(stage_frame, first):
    stage = stage_frame("customer", [{"customer_id": "1", "name": "A"}, {"customer_id": "8", "name": "H"}])
    rows, _ = clean_rows(stage, CUSTOMER)
    numbered = numbered_new(rows, first, "customer_id", "customer_sk", 1000)
    assert {r.customer_id: r.customer_sk is not None for r in numbered.collect()} == {1: False, 8: True}


def test_highest_number(spark):
    frame = spark.range(3).selectExpr("id AS n")
    assert spark.range(1).select(highest(frame, "n").alias("v")).first().v == 2
    nothing = frame.filter("n < 0")
    assert spark.range(1).select(highest(nothing, "n").alias("v")).first().v == 0


def test_backfill_overwrites_matched_keys_only(spark, stage_frame):
    restaurant = ENTITIES["restaurant"]
    stage = stage_frame(
        "restaurant",
        [
            {"restaurant_id": "1", "name": "A", "created_date": "2024-01-05 08:00:00", "modified_date": "x"},
            {"restaurant_id": "2", "name": "B", "created_date": "05-01-2024 08:00", "modified_date": "05-01-2024 08:00"},
        ],
    )
    table, _ = upsert(empty(spark, restaurant.clean_schema()), stage, restaurant, T1)
    table = table.cache()
    fixed = by_key(
        backfill_dates(table, stage.filter("restaurant_id = '1'"), restaurant, "yyyy-MM-dd HH:mm:ss"),
        "restaurant_id",
    )
    assert fixed[1]["created_dt"] == datetime(2024, 1, 5, 8) and fixed[1]["modified_dt"] is None
    assert fixed[2]["created_dt"] == datetime(2024, 1, 5, 8)
    # an unparsable value overwrites too
    gone = by_key(backfill_dates(table, stage, restaurant, "yyyy-MM-dd HH:mm:ss"), "restaurant_id")
    assert gone[2]["created_dt"] is None


def test_backfill_takes_the_latest_copy(spark, stage_frame):
    restaurant = ENTITIES["restaurant"]
    old = stage_frame("restaurant", [{"restaurant_id": "1", "name": "A", "created_date": "2024-01-01 00:00:00"}])
    new = stage_frame(
        "restaurant",
        [{"restaurant_id": "1", "name": "A", "created_date": "2024-01-02 00:00:00"}],
        copied="2024-03-05 00:00:00",
    )
    table, _ = upsert(empty(spark, restaurant.clean_schema()), old, restaurant, T1)
    fixed = backfill_dates(table, old.unionByName(new), restaurant, None)
    assert [r.created_dt for r in fixed.collect()] == [datetime(2024, 1, 2)]


def test_backfill_takes_both_dates_from_one_row(spark, stage_frame):
    restaurant = ENTITIES["restaurant"]
    rows = [
        {"restaurant_id": "1", "name": "A", "created_date": "2024-06-06 00:00:00", "modified_date": "2024-01-01 00:00:00"},
        {"restaurant_id": "1", "name": "B", "created_date": "2024-01-01 00:00:00", "modified_date": "2024-02-02 00:00:00"},
    ]
    stage = stage_frame("restaurant", rows)
    table, _ = upsert(empty(spark, restaurant.clean_schema()), stage, restaurant, T1)
    fixed = backfill_dates(table, stage, restaurant, None).first()
    dates = {"A": (datetime(2024, 6, 6), datetime(2024, 1, 1)), "B": (datetime(2024, 1, 1), datetime(2024, 2, 2))}
    assert (fixed.created_dt, fixed.modified_dt) == dates[fixed.name]
