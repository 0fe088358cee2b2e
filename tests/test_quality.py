import re
from datetime import datetime, timedelta

import pytest

from tidemark.entities import ENTITIES, Column, Entity, ForeignKey
from tidemark.operators import quality
from tidemark.operators.upsert import upsert
from tidemark.plans import reports
from tidemark.sources.tables import empty
from tidemark.streaming.feed import stage_table_schema

NOW = datetime(2024, 3, 1, 12)

GOOD = {
    "location": [{"location_id": "1", "city": "Bonn", "state": "NRW", "zipcode": "53111"}],
    "customer": [{"customer_id": "1", "name": "Ada"}],
    "restaurant": [
        {"restaurant_id": "1", "name": "R", "location_id": "1", "created_date": "05-01-2024 08:00"}
    ],
    "menu": [{"menu_id": "1", "restaurant_id": "1", "item_name": "Soup"}],
    "delivery_agent": [{"delivery_agent_id": "1", "name": "G", "location_id": "1"}],
    "customer_address": [{"address_id": "1", "customer_id": "1"}],
    "orders": [{"order_id": "1", "customer_id": "1", "restaurant_id": "1"}],
    "order_item": [{"order_item_id": "1", "order_id": "1", "menu_id": "1"}],
    "delivery": [{"delivery_id": "1", "order_id": "1", "delivery_agent_id": "1"}],
}


@pytest.fixture(scope="module")
def checks(spark, stage_frame):
    loaded = {}

    def load(name, rows):
        if (name, repr(rows)) not in loaded:
            entity = ENTITIES[name]
            stage = stage_frame(name, rows)
            clean = upsert(empty(spark, entity.clean_schema()), stage, entity, NOW)[0]
            loaded[name, repr(rows)] = stage, clean.cache()
        return loaded[name, repr(rows)]

    def run(changes=None, **options):
        rows = GOOD | (changes or {})
        stage = {n: load(n, rows[n])[0] for n in ENTITIES}
        clean = {n: load(n, rows[n])[1] for n in ENTITIES}
        log = quality.run_checks(stage, clean, "b", NOW, **options)
        return {r.table_name: r for r in log.collect()}

    return run


def test_clean_load_passes(checks):
    log = checks(last_run_id=9)
    assert [log[n].run_id for n in ENTITIES] == list(range(10, 19))
    assert {r.overall_status for r in log.values()} == {"PASS"}
    assert log["location"].fk_check_status == "N/A" and log["location"].fk_check_detail is None
    assert log["delivery"].fk_check_detail == "order_id:PASS;delivery_agent_id:PASS"
    assert {r.layer_transition for r in log.values()} == {"stage_to_clean"}


def test_lost_date_fails_one_cell(checks):
    log = checks({"menu": GOOD["menu"] + [GOOD["menu"][0] | {"menu_id": "2", "created_date": "NOT_A_DATE"}]})
    menu = log["menu"]
    assert (menu.rows_in, menu.rows_out) == (2, 2)
    assert (menu.null_check_status, menu.fk_check_status, menu.overall_status) == ("FAIL", "PASS", "FAIL")
    assert {n for n, r in log.items() if r.overall_status == "FAIL"} == {"menu"}


def test_orphans_are_counted_per_reference(checks):
    items = [{"order_item_id": str(i), "order_id": "77", "menu_id": "1"} for i in range(1, 4)]
    log = checks({"order_item": items})
    assert log["order_item"].fk_check_detail == "order_id:FAIL(3);menu_id:PASS"
    assert log["order_item"].overall_status == "FAIL"
    assert log["order_item"].null_check_status == "PASS"


def test_rejected_and_resent_rows_fail_the_row_count(checks):
    log = checks(
        {
            "customer": GOOD["customer"] + [{"customer_id": "x", "name": "B"}],
            "orders": GOOD["orders"] * 2,
        }
    )
    assert (log["customer"].rows_in, log["customer"].rows_out) == (2, 1)
    assert log["customer"].overall_status == "FAIL"
    assert (log["orders"].rows_in, log["orders"].rows_out) == (2, 1)
    assert log["orders"].overall_status == "FAIL"
    counted_by_key = checks({"orders": GOOD["orders"] * 2}, distinct_key=True)
    assert counted_by_key["orders"].overall_status == "PASS"


def test_faulty_keys_fail_also_where_keys_count_once(checks):
    customers = GOOD["customer"] * 2 + [{"customer_id": "x9", "name": "B"}]
    bad = checks({"customer": customers}, distinct_key=True)["customer"]
    assert (bad.rows_in, bad.rows_out, bad.overall_status) == (2, 1, "FAIL")
    large = checks({"customer": GOOD["customer"] + [{"customer_id": "9" * 30, "name": "B"}]}, distinct_key=True)
    assert large["customer"].overall_status == "FAIL"


def test_required_null_reference_is_rejected_and_counted(checks):
    log = checks({"delivery": GOOD["delivery"] + [{"delivery_id": "2", "order_id": "9", "delivery_agent_id": "7"}]})
    assert log["delivery"].fk_check_detail == "order_id:FAIL(1);delivery_agent_id:FAIL(1)"


def test_null_reference_counts_only_where_it_must(spark):
    entities = [
        Entity("p", (Column("p_id", "key", "p_id"),), lost_value_columns=()),
        Entity(
            "c",
            (Column("c_id", "key", "c_id"), Column("a", "key", "a"), Column("b", "key", "b")),
            foreign_keys=(ForeignKey("a", "p"), ForeignKey("b", "p", null_is_orphan=True)),
            lost_value_columns=(),
        ),
    ]
    parent = spark.createDataFrame([(1,)], "p_id long")
    child = spark.createDataFrame([(1, 1, 1), (2, None, None), (3, 5, 5), (4, 5, 1)], "c_id long, a long, b long")
    stage = {"p": parent.selectExpr("CAST(p_id AS string) AS p_id"), "c": child.selectExpr("CAST(c_id AS string) AS c_id")}
    log = quality.run_checks(stage, {"p": parent, "c": child}, "b", NOW, entities=entities).collect()
    assert {r.table_name: r.fk_check_detail for r in log} == {"p": None, "c": "a:FAIL(2);b:FAIL(2)"}


def test_checks_pass_each_table_once(spark, tmp_path):
    stage, clean = {}, {}
    for name, entity in ENTITIES.items():
        for kind, schema, into in (("s", stage_table_schema(entity), stage), ("c", entity.clean_schema(), clean)):
            spark.createDataFrame([], schema).write.parquet(str(tmp_path / kind / name))
            into[name] = spark.read.schema(schema).parquet(str(tmp_path / kind / name))
    plan = quality.run_checks(stage, clean, "b", NOW)._jdf.queryExecution().executedPlan().toString()
    for name in ENTITIES:
        assert len(re.findall(rf"FileScan parquet[^\n]*/s/{name}\]", plan)) <= 1
        assert len(re.findall(rf"FileScan parquet[^\n]*/c/{name}\]", plan)) <= 2
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_optional_null_reference_passes(checks):
    log = checks({"restaurant": [GOOD["restaurant"][0] | {"location_id": None}]})
    assert log["restaurant"].overall_status == "PASS"


def log_frame(spark, rows):
    full = [(i, "t", t, 1, 1, "PASS", "PASS", None, s, ts, b) for i, t, s, ts, b in rows]
    return spark.createDataFrame(full, quality.LOG_SCHEMA)


def test_gate_window_includes_its_first_instant(spark):
    log = log_frame(spark, [(1, "menu", "FAIL", NOW, "a"), (2, "menu", "PASS", NOW, "a")])
    five = timedelta(minutes=5)
    held = quality.gate(log, now=NOW + five).first()
    assert (held.status, held.fail_count) == ("SKIPPED", 1) and "1 failed" in held.message
    free = quality.gate(log, now=NOW + five + timedelta(seconds=1)).first()
    assert (free.status, free.fail_count) == ("OK", 0)


def test_gate_by_batch_and_empty_log(spark):
    log = log_frame(spark, [(1, "menu", "FAIL", NOW, "a"), (2, "menu", "PASS", NOW, "b")])
    assert quality.gate(log, batch_id="a", expected=1).first().status == "SKIPPED"
    assert quality.gate(log, batch_id="b", expected=1).first().status == "OK"
    for batch, checked in (("b", 1), ("mistyped", 0)):
        held = quality.gate(log, batch_id=batch).first()
        assert (held.status, held.fail_count) == ("SKIPPED", 0) and f"{checked} of 9 tables" in held.message
    assert quality.gate(log.filter("false"), now=NOW).first().status == "OK"


def test_latest_status_and_newest_row(spark):
    log = log_frame(
        spark,
        [(1, "menu", "FAIL", NOW, "a"), (2, "orders", "PASS", NOW, "a"), (3, "menu", "PASS", NOW, "b")],
    )
    rows = [(r.table_name, r.overall_status) for r in quality.latest_status(log).collect()]
    assert rows == [("menu", "PASS"), ("orders", "PASS")]
    assert "fk_check_detail" not in quality.latest_status(log).columns
    assert reports.newest_log_row(log).first().run_id == 3
    assert reports.newest_log_row(log, "orders").first().run_id == 2
