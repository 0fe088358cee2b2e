"""Late rows, restarts and joins of streams."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.streaming import event_time, feed

DAY, DELAY = timedelta(days=1), timedelta(hours=12)
SCHEMA = T.StructType().add("id", "long").add("ts", "timestamp").add("kind", "string").add("amount", "decimal(12,2)")
SUMS = T.StructType().add("window_start", "timestamp").add("kind", "string").add("amount", "decimal(22,2)").add("events", "long")


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


DELIVERIES = [
    [(1, at(1, 5), "a", 1), (2, at(1, 6), "b", 2), (3, at(3, 1), "a", 4)],
    # watermark: 2 January, 13:00; the first of January is closed, the second is not
    [(4, at(1, 7), "a", 8), (5, at(2, 2), "a", 16), (6, None, "a", 1), (7, at(3, 2), "a", 32), (8, at(4, 23), None, 64)],
    # watermark: 4 January, 11:00
    [(9, at(2, 23), "a", 128), (10, at(3, 23), "b", 256), (11, at(4, 1), "a", 512)],
    [],
    [(12, at(4, 2), "a", 1024)],
]
LATE = {4: "late", 6: "no time", 9: "late", 10: "late"}


def run(spark, root, number):
    rows = [(i, t, k, None if v is None else v) for i, t, k, v in DELIVERIES[number]]
    frame = spark.createDataFrame(rows, "id long, ts timestamp, kind string, amount long")
    frame.withColumn("amount", F.col("amount").cast("decimal(12,2)")).write.mode("append").parquet(f"{root}/landed")
    settle(spark, root)


def settle(spark, root):
    arrived = feed.changes(spark, SCHEMA, f"{root}/landed")
    event_time.triage(arrived, root, "ts", DAY, DELAY)
    event_time.window_totals(spark, root, SCHEMA, "ts", "kind", "amount", DAY, DELAY)


def state(spark, root):
    sums = event_time.totals(spark, root, SUMS).collect()
    late = event_time.late_rows(spark, root, SCHEMA).collect()
    return (
        {(r.window_start, r.kind): (int(r.amount), r.events) for r in sums},
        {r.id: r.late_reason for r in late},
    )


def in_time():
    out = {}
    for i, t, kind, amount in sum(DELIVERIES, []):
        if i not in LATE:
            key = (datetime(t.year, t.month, t.day), kind)
            total, events = out.get(key, (0, 0))
            out[key] = (total + amount, events + 1)
    return out


def test_late_rows_are_kept_apart_and_the_rest_is_summed(spark, tmp_path):
    root = str(tmp_path)
    for number in range(len(DELIVERIES)):
        run(spark, root, number)
    assert state(spark, root) == (in_time(), LATE)
    # Nothing new: nothing changes.
    settle(spark, root)
    assert state(spark, root) == (in_time(), LATE)


@pytest.mark.parametrize("where", ["before the mark", "in totals"])
def test_a_batch_that_failed_is_taken_again(spark, tmp_path, monkeypatch, where):
    root = str(tmp_path)
    run(spark, root, 0)

    def killed(*args, **kwargs):
        raise RuntimeError("killed")

    if where == "in totals":
        monkeypatch.setattr(event_time, "replace_parts", killed)
    else:
        original = type(spark).createDataFrame

        def no_mark(self, data, schema=None, *args, **kwargs):
            make = killed if schema == "watermark long" else original
            return make(self, data, schema, *args, **kwargs)

        monkeypatch.setattr(type(spark), "createDataFrame", no_mark)
    with pytest.raises(Exception, match="killed"):
        run(spark, root, 1)
    monkeypatch.undo()
    settle(spark, root)
    for number in (2, 3, 4):
        run(spark, root, number)
    assert state(spark, root) == (in_time(), LATE)


def test_unmatched_rows_come_out_after_the_watermark(spark, tmp_path):
    left = T.StructType().add("k", "long").add("a", "timestamp")
    right = T.StructType().add("k", "long").add("b", "timestamp")
    hour = timedelta(hours=1)
    deliveries = [
        ([(1, at(1)), (2, at(1)), (3, at(1, 6))], [(1, at(1, 2)), (1, at(1, 3)), (2, at(1, 9))]),
        ([(4, at(3))], [(3, at(1, 5)), (4, at(3, 1))]),
        ([(-1, at(30))], [(-1, at(30))]),
    ]
    shown = []
    for lefts, rights in deliveries:
        spark.createDataFrame(lefts, left).write.mode("append").parquet(f"{tmp_path}/left")
        spark.createDataFrame(rights, right).write.mode("append").parquet(f"{tmp_path}/right")
        streams = [feed.changes(spark, s, f"{tmp_path}/{n}") for n, s in (("left", left), ("right", right))]
        joined = event_time.within(*streams, "k", "a", "b", hour, 3 * hour, timedelta(days=1))
        event_time.collect(joined, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        rows = spark.read.schema(joined.schema).parquet(f"{tmp_path}/out").filter("k >= 0").collect()
        shown.append({(r.k, r.b) for r in rows})
    # 1 has two partners; 2's came too late, but the watermark has to say so first.
    assert shown[0] == {(1, at(1, 2)), (1, at(1, 3))}
    assert (3, at(1, 5)) in shown[1]
    assert shown[2] == {(1, at(1, 2)), (1, at(1, 3)), (2, None), (3, at(1, 5)), (4, at(3, 1))}
    tables = [spark.read.schema(s).parquet(f"{tmp_path}/{n}").filter("k >= 0") for n, s in (("left", left), ("right", right))]
    batch = event_time.within(*tables, "k", "a", "b", hour, 3 * hour, timedelta(days=1))
    assert {(r.k, r.b) for r in batch.collect()} == shown[2]
