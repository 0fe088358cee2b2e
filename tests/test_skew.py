"""A key that holds a third of the rows is split or combined, and nothing is lost on the way."""

import pytest

from tidemark.operators.clean import last_per_key
from tidemark.operators.joins import splittable_join

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_is_split(spark, small_partitions, how):
    items = spark.range(0, 90000, 1, 8).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "uuid() AS payload"
    )
    # already partitioned by the key, as the outcome of an aggregation is
    parents = spark.range(90000).selectExpr("id AS k").distinct().selectExpr("k", "k + 1 AS v")
    joined = splittable_join(items, parents, "k", how).selectExpr(
        "count(*) AS n", "sum(v) AS v", "max(payload) AS p"
    )
    row = joined.collect()[0]
    assert (row.n, row.v) == (90000, sum((7 if i % 3 == 0 else i) + 1 for i in range(90000)))
    plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "skew=true" in plan


def test_join_keeps_unmatched_left_rows(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k long, v string")
    right = spark.createDataFrame([(1, True)], "k long, hit boolean")
    rows = sorted((r.v, r.hit) for r in splittable_join(left, right, "k", "left").collect())
    assert rows == [("a", True), ("b", None), ("c", None)]
    assert splittable_join(left, right, "k").columns == ["k", "v", "hit"]


def test_hot_key_of_a_batch_shrinks_before_the_shuffle(spark):
    rows = spark.range(0, 30000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k",
        "'f' AS _stg_file_name",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS _copy_ts",
    )
    last = last_per_key(rows, "k")
    # 7 itself is no multiple of 3, so it counts among the other keys
    assert last.count() == 20000
    assert str(last.filter("k = 7").first()._copy_ts) == "2024-01-01 08:19:57"
