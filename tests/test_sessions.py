"""Sessions next to a plain reading of the rule, as a batch and as a stream."""

import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators.sessions import user_sessions
from tidemark.streaming import event_time, feed

START, GAP = datetime(2024, 1, 1), timedelta(minutes=30)
SCHEMA = "user long, ts timestamp, amount decimal(12,2)"


def expected(rows, gap=GAP):
    out, by_user = [], {}
    for user, ts, amount in rows:
        if user is not None and ts is not None:
            by_user.setdefault(user, []).append((ts, amount))
    for user, events in by_user.items():
        events.sort(key=lambda e: e[0])
        run = []
        for ts, amount in [*events, (datetime.max, 0)]:
            if run and ts - run[-1][0] > gap:
                out.append((user, run[0][0], run[-1][0], len(run), sum(a for _, a in run)))
                run = []
            run.append((ts, amount))
    return sorted(out)


def made(seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(5), START + timedelta(seconds=rng.randrange(6 * 86400)), rng.randrange(100)) for _ in range(400)]
    # a third of all events is one user's: a chain over several days without a pause, exactly the gap apart
    rows += [(7, START + timedelta(hours=20) + k * GAP, 1) for k in range(200)]
    rows += [(7, rows[-1][1] + GAP + timedelta(microseconds=1), 1), (8, START, 1), (8, START, 2), (8, START + timedelta(days=1), 3)]
    return rows + [(None, START, 1), (3, None, 1)]


def shown(df):
    return sorted((r.user, r.session_start, r.session_end, r.events, int(r.amount)) for r in df.collect())


@pytest.mark.parametrize("hours", [1, 24, 10_000])
def test_equals_the_plain_rule(spark, hours):
    rows = made(hours)
    frame = spark.createDataFrame(rows, "user long, ts timestamp, amount long").repartition(3)
    assert shown(user_sessions(frame, "user", "ts", "amount", GAP, slice_hours=hours)) == expected(rows)


def test_no_events(spark):
    assert user_sessions(spark.createDataFrame([], SCHEMA), "user", "ts", "amount", GAP).count() == 0


def test_a_hot_user_is_not_one_task(spark):
    events = spark.range(0, 30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS user", "timestamp '2024-01-01' + make_dt_interval(0, 0, id) AS ts", "id AS amount"
    )
    found = user_sessions(events, "user", "ts", "amount", GAP)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # rows are windowed by user and slice; by user alone only what a slice is reduced to
    assert "lag(_micros" in plan and plan.split("lag(_micros")[1].split("windowspecdefinition(")[1].split(" ASC")[0].count("_slice") == 1
    hot = found.filter("user = 1 AND events > 1").collect()
    # event 1 is of user 1 as well
    assert [r.events for r in hot] == [10001]


def test_the_stream_gives_the_same(spark, tmp_path):
    rows = [r for r in made(3) if r[1] is not None]
    frame = spark.createDataFrame(rows, "user long, ts timestamp, amount long")
    last = spark.createDataFrame([(None, datetime(2100, 1, 1), 0)], frame.schema)
    parts = [frame.filter(f"ts < '2024-01-03'"), frame.filter("ts >= '2024-01-03'"), last]
    for number, part in enumerate(parts):
        part.write.mode("append").parquet(f"{tmp_path}/landed")
        found = event_time.sessions(feed.changes(spark, frame.schema, f"{tmp_path}/landed"), "user", "ts", "amount", GAP, timedelta(hours=1))
        event_time.collect(found, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = spark.read.schema(found.schema).parquet(f"{tmp_path}/out").filter("user IS NOT NULL")
    assert shown(got) == expected(rows)
