"""What the layered job and the queries over it leave on disk and move: each row few times, nothing longer than it is read."""

import glob
import re
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.entities import ENTITIES
from tidemark.operators import consumption
from tidemark.operators.as_of import as_of
from tidemark.operators.joins import marked
from tidemark.operators.numbering import number_rows
from tidemark.operators.quality import _Codes, _clean_marks, _references
from tidemark.operators.upsert import apply_dealt, apply_rows, merge, merge_stored, numbered_new
from tidemark.plans.refresh import BUCKET, LayeredJob
from tidemark.registry import queries
from tidemark.sources.tables import bucket_of
from test_refresh import EXTRACTS, T1, T2, deliver, start

CUSTOMER = ENTITIES["customer"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def customers(spark, ids, name, number=None):
    """Customers as typed rows of a batch, or with ``number`` as a table."""
    cells = {"customer_id": "id", "name": f"'{name}'", "created_dt": f"timestamp_ntz '2024-01-0{len(name)} 00:00:00'", "customer_sk": number}
    fields = [f for f in CUSTOMER.clean_schema() if number or f.name != "customer_sk"]
    columns = [f"CAST({cells.get(f.name) or 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields]
    rows = spark.createDataFrame([(i,) for i in ids], "id long").selectExpr(*columns)
    return rows.withColumn(BUCKET, bucket_of("customer_id", 4))


def shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return [n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")]


def test_shuffle_files_go_when_their_query_ends(spark):
    spark.sparkContext._jvm.System.gc()
    before = set(shuffle_files(spark))
    rows = spark.range(3000).groupBy(F.expr("id % 70 AS k")).agg(F.count("*").alias("n"))
    assert sum(r.n for r in rows.collect()) == 3000
    # Held by the frame, so nothing is left to the collection of garbage.
    until = time.time() + 20
    while set(shuffle_files(spark)) - before and time.time() < until:
        time.sleep(0.2)
    assert not set(shuffle_files(spark)) - before
    assert sum(r.n for r in rows.collect()) == 3000


def test_a_batch_meets_its_stored_table_in_one_shuffle(spark, tmp_path):
    customers(spark, range(40), "old", "id + 1").write.parquet(f"{tmp_path}/old")
    customers(spark, range(30, 60), "newer").write.parquet(f"{tmp_path}/new")
    schema = T.StructType([*CUSTOMER.clean_schema().fields, T.StructField(BUCKET, T.IntegerType())])
    target, rows = spark.read.schema(schema).parquet(f"{tmp_path}/old"), spark.read.parquet(f"{tmp_path}/new")
    dealt = apply_dealt(target, rows, CUSTOMER, 40, BUCKET, 16)
    plain = apply_rows(target.drop(BUCKET), rows.drop(BUCKET), CUSTOMER, 40)
    same = [c for c in plain.columns if c != "customer_sk"]
    assert dealt.select(same).exceptAll(plain.select(same)).count() == 0 and dealt.count() == plain.count() == 60
    numbers = {r.customer_id: r.customer_sk for r in dealt.collect()}
    assert all(numbers[i] == i + 1 for i in range(40))
    assert len(set(numbers.values())) == 60 and min(numbers[i] for i in range(40, 60)) > 40
    assert dealt.filter(f"NOT {BUCKET} <=> pmod(xxhash64(customer_id), 4)").count() == 0
    assert plan_of(dealt).count("Exchange") == 1 < plan_of(plain).count("Exchange")
    assert dealt.schema["email"].metadata == CUSTOMER.clean_schema()["email"].metadata


def test_a_lane_is_a_part_of_one_bucket_and_rows_lie_in_that_order(spark):
    rows = number_rows(customers(spark, range(500), "x"), "customer_id", "customer_sk", 0, 16, BUCKET)
    assert rows.groupBy(F.expr("(customer_sk - 1) % 16")).agg(F.count_distinct(BUCKET).alias("n")).filter("n > 1").count() == 0
    plan = plan_of(rows.sortWithinPartitions(BUCKET))
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_a_stored_row_that_is_there_twice_is_merged_once(spark):
    target = spark.createDataFrame([(1, 5, "a"), (1, 5, "a"), (2, 6, "b"), (3, 7, None)], "k long, n long, v string")
    source = spark.createDataFrame([(1, 50, "z"), (3, 70, None), (4, 80, "d")], "k long, n long, v string")
    found = merge_stored(target, source, "k", ["v"])
    assert sorted(map(tuple, found.collect())) == [(1, 5, "z"), (2, 6, "b"), (3, 7, None), (4, 80, "d")]
    plain = merge(target.distinct(), source, "k", ["v"])
    assert plain.exceptAll(found).count() == 0 and plain.schema == found.schema
    assert plan_of(found).count("Exchange") == 1


def test_an_item_with_several_causes_is_found_once_without_a_shuffle_by_item(spark):
    items = spark.createDataFrame(
        [(i, i % 5, i % 3, i == 7) for i in range(1, 21)], "order_item_id long, order_id long, menu_id long, _written boolean"
    )
    written = items.filter("_written").drop("_written")
    orders = spark.createDataFrame([(2,), (2,), (None,)], "order_id long")
    menu = spark.createDataFrame([(1,)], "menu_id long")
    expected = sorted(i for i in range(1, 21) if i == 7 or i % 5 == 2 or i % 3 == 1)
    found = consumption.items_to_refresh(items, written, orders, menu)
    assert sorted(r.order_item_id for r in found.collect()) == expected and found.columns == written.columns
    joined = marked(marked(items, orders, "order_id", "a", 0), menu, "menu_id", "b", 0)
    assert sorted(r.order_item_id for r in joined.filter("_written OR a OR b").collect()) == expected
    assert joined.count() == 20 and "order_item_id#" not in "".join(x for x in plan_of(joined).splitlines() if "Exchange" in x)
    assert consumption.items_to_refresh(items, written, orders.limit(0), menu.limit(0)).count() == 1


def test_the_job_leaves_no_table_that_is_read_no_more(spark, tmp_path):
    job, landing = start(spark, tmp_path, distinct_key=True)
    job.run(T1)
    deliver(landing, "customer", [EXTRACTS["customer"][1].replace("c2@x", "new@x")], "two.csv")
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:").rstrip("/")
    # Those of other tests that were stopped in between may lie there.
    kinds = ("batch-*", "changed-items-*", "changed-facts-*")
    before = {p for k in kinds for p in glob.glob(f"{folder}/{k}")}
    assert job.run(T2).status == "OK"
    assert {p for k in kinds for p in glob.glob(f"{folder}/{k}")} <= before
    assert job.clean("customer").filter("email = 'new@x'").count() == 1


def test_extracts_lie_compressed_and_are_landed_whole(spark, stage_frame, tmp_path):
    rows = [{"location_id": str(i), "city": f'C "{i}", x', "state": "S", "active_flag": "Y"} for i in range(30)]
    queries._export(spark, str(tmp_path), {"location": stage_frame("location", rows)})
    assert glob.glob(f"{tmp_path}/landing/location/*.csv.gz") and not glob.glob(f"{tmp_path}/landing/location/*.csv")
    job = LayeredJob(spark, f"{tmp_path}/tables", f"{tmp_path}/landing")
    job._refresh_entity(ENTITIES["location"], datetime(2024, 3, 1))
    assert sorted((r.location_id, r.city) for r in job.clean("location").collect()) == [(i, f'C "{i}", x') for i in range(30)]


def test_marks_are_made_by_compiled_code(spark):
    clean = spark.createDataFrame([], ENTITIES["orders"].clean_schema())
    marks = _clean_marks(clean, ENTITIES["orders"], _references(list(ENTITIES.values())), _Codes())
    assert "lambda" not in marks._jdf.queryExecution().optimizedPlan().toString()


def test_keys_of_a_stored_table_do_not_go_to_the_driver(spark, tmp_path):
    customers(spark, range(40), "old", "id + 1").write.parquet(f"{tmp_path}/old")
    customers(spark, range(30, 60), "newer").write.parquet(f"{tmp_path}/new")
    target, rows = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("old", "new"))
    numbered = numbered_new(rows, target, "customer_id", "customer_sk", 40)
    assert numbered.filter("customer_sk IS NOT NULL").count() == 20
    # Files of some kilobytes, far below what Spark broadcasts.
    assert "BroadcastHashJoin" not in plan_of(numbered) and plan_of(numbered).count("SortMergeJoin") == 2


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Small given tables."""
    path, day = tmp_path_factory.mktemp("base"), "timestamp '1995-01-01 00:00:00' + make_dt_interval(CAST(id AS int))"
    tables = {
        "region": (2, "CAST(id AS int) AS r_regionkey, concat('R', id) AS r_name"),
        "nation": (4, "CAST(id AS int) AS n_nationkey, concat('N', id) AS n_name, CAST(id % 2 AS int) AS n_regionkey"),
        "customer": (30, "id AS c_custkey, concat('C', id) AS c_name, CAST(id % 4 AS int) AS c_nationkey, 1.5D AS c_acctbal, 'M' AS c_mktsegment"),
        "supplier": (10, "id AS s_suppkey, concat('S', id) AS s_name, CAST(id % 4 AS int) AS s_nationkey, 2.5D AS s_acctbal"),
        "part": (20, "id AS p_partkey, concat('P', id) AS p_name, 'Brand#11' AS p_brand, 'T' AS p_type, 1 AS p_size, 2.5D AS p_retailprice"),
        "orders": (60, f"id AS o_orderkey, id % 30 AS o_custkey, 'F' AS o_orderstatus, 9.5D AS o_totalprice, {day} AS o_orderdate, '1-URGENT' AS o_orderpriority"),
        "lineitem": (200, f"id % 60 AS l_orderkey, id % 20 AS l_partkey, id % 10 AS l_suppkey, CAST(id DIV 60 AS int) AS l_linenumber, 1D AS l_quantity, 3D AS l_extendedprice, {day} AS l_shipdate"),
    }
    for name, (rows, columns) in tables.items():
        spark.range(rows).createOrReplaceTempView("ids")
        spark.sql(f"SELECT {columns} FROM ids").write.parquet(f"{path}/{name}.parquet")
    return str(path)


def scans(df):
    """The stored tables that a frame reads, without the unique end of their names."""
    return sorted({re.sub(r"-[0-9a-f]{32}$", "", path.split("/")[-2]) for path in df.inputFiles()})


def test_both_facts_are_stored_before_they_are_merged(spark, base):
    found = queries.order_item_fact(spark, base)
    assert scans(found) == ["fact"] and len({path.split("/")[-2] for path in found.inputFiles()}) == 2
    assert found.select("order_item_id").distinct().count() == found.count() > 100


def test_steps_of_an_as_of_fact_are_stored(spark, base):
    found = queries.order_item_fact_as_of(spark, base)
    assert scans(found) == ["found", "menu_dim", "timed-items"]
    assert found.select("order_item_id").distinct().count() == found.count() > 100


def test_both_passes_over_slices_read_one_shuffle(spark):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(50).selectExpr("id", "id % 5 AS k", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(CAST(id AS int)) AS at")
        versions = "k AS key, at AS eff_start_date, CAST(NULL AS timestamp_ntz) AS eff_end_date, id AS v"
        found = as_of(rows, rows.selectExpr("k", *versions.split(", ")[1:]).filter("v % 3 = 0"), "k", "at", ["v"], early=True)
        assert "ReusedExchange" in plan_of(found) and found.count() == 50
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_keys_that_nothing_refers_to_leave_no_mark(spark):
    spec, codes = ENTITIES["order_item"], _Codes()
    clean = spark.createDataFrame([tuple([1] * 4 + [None] * 8)], spec.clean_schema())
    parents = {fk.parent for e in ENTITIES.values() for fk in e.foreign_keys}
    marks = _clean_marks(clean, spec, _references(list(ENTITIES.values())), codes, parents)
    # That it is there, its order, its dish, and that it has no date.
    assert "ref order_item" not in codes and marks.count() == 4
    orders = _clean_marks(spark.createDataFrame([], ENTITIES["orders"].clean_schema()), ENTITIES["orders"], _references(list(ENTITIES.values())), codes, parents)
    assert "ref orders" in codes and orders.count() == 0


def test_the_largest_table_is_loaded_by_itself(spark, base, monkeypatch):
    together, real = [], queries.side_by_side
    monkeypatch.setattr(queries, "side_by_side", lambda spark, tasks: together.append(len(tasks)) or real(spark, tasks))
    found = {r.table_name: (r.rows_in, r.rows_out) for r in queries.dq_checks_resent(spark, base).collect()}
    assert together == [len(ENTITIES) - 1] and len(found) == len(ENTITIES)
    assert found["order_item"] == (200, 200) and found["orders"] == (60, 60)


def test_numbers_are_counted_by_a_query_per_table(spark, base):
    found = queries.surrogates_stable(spark, base)
    assert "Join" not in plan_of(found) and "Exchange" not in plan_of(found)
    counts = {r.table_name: (r.row_count, r.numbers, r.kept) for r in found.collect()}
    assert len(counts) == len(ENTITIES) and all(rows == numbers >= kept for rows, numbers, kept in counts.values())
