"""Steps that grow with the largest tables: read once, parsed once, kept narrow."""

import pytest
from pyspark.sql import types as T

from tidemark.entities import ENTITIES
from tidemark.functions.typing_rules import as_key
from tidemark.operators import quality
from tidemark.operators.clean import faults, loadable
from tidemark.operators.difference import row_difference
from tidemark.operators.upsert import apply_rows
from tidemark.registry import queries, roles
from tidemark.sources.tables import empty

WRITTEN = ["1", " 7", "+5", "-0", "007", "12.5", "1e2", "9223372036854775807", "9223372036854775808", "1\x7f", "x", "", None]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_key_by_the_direct_cast_is_that_by_decimal(spark):
    rows = spark.createDataFrame([(t,) for t in WRITTEN], "t string")
    plain = "try_cast(try_cast(t AS decimal(38,0)) AS bigint)"
    assert rows.filter(f"NOT ({as_key('t')}) <=> {plain}").count() == 0
    assert as_key("t").startswith("CASE WHEN CAST(try_cast(t AS bigint) AS string) = t")


def test_a_first_load_numbers_its_rows_in_one_shuffle(spark, tmp_path):
    spec = ENTITIES["location"]
    fields = [f for f in spec.clean_schema().fields if f.name != spec.surrogate]
    rows = spark.createDataFrame([(k, *[None] * (len(fields) - 1)) for k in (5, 3, 9)], T.StructType([T.StructField(f.name, f.dataType) for f in fields]))
    target = empty(spark, spec.clean_schema())
    first, plain = (apply_rows(target, rows, spec, 0, first=f) for f in (True, False))
    assert sorted(map(str, first.collect())) == sorted(map(str, plain.collect()))
    assert plan_of(first).count("Exchange") == 1 < plan_of(plain).count("Exchange")


def test_loadable_rows_are_those_without_faults(stage_frame):
    keys = ["1", "x", None, "9" * 30, "12.5"]
    rows = [{"order_item_id": a, "order_id": b, "menu_id": "3", "_malformed": m} for a in keys for b in keys for m in (None, "1,2")]
    spec, stage = ENTITIES["order_item"], stage_frame("order_item", rows)
    both = stage.selectExpr(f"({faults(stage, spec)}) IS NULL AS a", f"{loadable(stage, spec)} AS b").collect()
    assert all(r.a == r.b for r in both) and len({r.a for r in both}) == 2


def test_digests_are_two_numbers(spark):
    rows = spark.createDataFrame([(1, "a", None), (1, None, "a"), (2, "b", "c")], "k long, v string, w string")
    other = spark.createDataFrame([(1, "a", None), (2, "b", "c")], "k long, v string, w string")
    found = row_difference(rows, other, "k", ["k", "v", "w"])
    assert [tuple(r) for r in found.collect()] == [(1, 2, 1, 1, 1, 0)]
    first = [line for line in plan_of(found).splitlines() if "Exchange" in line][-1]
    assert "_high" in first and "_low" in first


def test_marks_have_a_fixed_width(spark, stage_frame):
    from datetime import datetime

    stage = {n: stage_frame(n, []) for n in ENTITIES}
    clean = {n: spark.createDataFrame([], s.clean_schema()) for n, s in ENTITIES.items()}
    codes = quality._Codes()
    marks = quality._clean_marks(clean["orders"], ENTITIES["orders"], quality._references(list(ENTITIES.values())), codes)
    assert {f.dataType.simpleString() for f in marks.schema} <= {"int", "bigint"}
    assert quality.run_checks(stage, clean, "b", datetime(2024, 3, 1)).count() == len(ENTITIES)


@pytest.fixture
def given(spark, tmp_path):
    spark.range(3).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "'t' AS p_type", "1 AS p_size", "2.5D AS p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(40).selectExpr(
        "id DIV 3 AS l_orderkey", "id % 3 AS l_partkey", "0L AS l_suppkey", "CAST(id % 3 AS int) AS l_linenumber",
        "1D AS l_quantity", "3D AS l_extendedprice", "timestamp '2024-01-01 00:00:00' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_a_stored_role_gives_the_same_batches(spark, given):
    role = roles.stored_role(spark, given, "order_item")
    for dirty in (False, True):
        plain = queries.first_stage(spark, given, "order_item", dirty)
        stored = queries.first_stage(spark, given, "order_item", dirty, role)
        assert plain.exceptAll(stored).count() == stored.exceptAll(plain).count() == 0
    plain, stored = (queries.second_stage(spark, given, "order_item", r) for r in (None, role))
    assert plain.exceptAll(stored).count() == stored.exceptAll(plain).count() == 0 < stored.count()


def test_two_loads_number_the_items_once(spark, given):
    plan = plan_of(queries.loaded_twice(spark, given, "order_item"))
    assert "l_orderkey" not in plan and "lineitem.parquet" not in plan
