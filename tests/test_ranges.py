"""Band joins, ranks, grouping levels and differences next to plain readings."""

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranking
from tidemark.operators.difference import row_difference
from tidemark.operators.grouping import cube_sets, grouping_levels, rollup_sets
from tidemark.operators.ranges import band_join
from tidemark.operators.ranking import ranked


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_values_meet_all_bands_they_lie_in(spark):
    rng = random.Random(1)
    points = [(i, rng.choice([rng.uniform(-5, 5), rng.randrange(-1000, 1000), None])) for i in range(300)]
    bands = []
    for j in range(60):
        low = rng.uniform(-1000, 1000)
        bands.append((j, low, low + rng.choice([-1, 0, 1e-9, 0.5, 3, 70, 5000])))
    bands += [(100, 7.0, 7.0), (101, None, 5.0), (102, -1e6, 1e6), (103, 4.0, 8.0), (104, 8.0, 16.0)]
    points += [(1000, 7.0), (1001, 8.0), (1002, 16.0), (1003, -0.0)]
    left = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in points], "i long, v double")
    right = spark.createDataFrame(bands, "j long, low double, high double")
    joined = band_join(left, right, "v", "low", "high")
    assert joined.columns == ["i", "v", "j", "low", "high"]
    got = sorted((r.i, r.j) for r in joined.collect())
    want = [(i, j) for (i, v), (j, a, b) in product(points, bands) if None not in (v, a, b) and a <= v <= b]
    assert got == sorted(want)
    assert "NestedLoop" not in plan(joined) and "CartesianProduct" not in plan(joined)
    assert band_join(left, right.limit(0), "v", "low", "high").count() == 0


@pytest.mark.parametrize("rows_per_range", [7, 500_000])
@pytest.mark.parametrize("descending", [True, False])
def test_ranks_equal_those_of_a_window(spark, monkeypatch, rows_per_range, descending):
    monkeypatch.setattr(ranking, "RANGE_ROWS", rows_per_range)
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "b", None, "c"]), rng.choice([None, 1, 2, 3, rng.randrange(50)])) for i in range(200)]
    rows += [(1000, "lone", None)]
    frame = spark.createDataFrame(rows, "i long, g string, v long").repartition(5)
    got = ranked(frame, "g", "v", "i", 4, descending)
    order = "v DESC NULLS LAST" if descending else "v ASC NULLS FIRST"
    over = "OVER (PARTITION BY g ORDER BY " + order
    want = frame.selectExpr(
        "*",
        f"row_number() {over}, i) AS row_number",
        f"rank() {over}) AS rank",
        f"dense_rank() {over}) AS dense_rank",
        f"percent_rank() {over}) AS percent_rank",
        f"ntile(4) {over}, i) AS tile",
    )
    key = lambda r: r[0]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert ranked(frame.limit(0), "g", "v", "i", 4).count() == 0


@pytest.mark.parametrize("sets", [rollup_sets(["a", "b", "c"]), cube_sets(["a", "b"]), [("a", "c"), ("b",), ("b",)]])
def test_levels_equal_grouping_sets(spark, sets):
    rng = random.Random(5)
    rows = [
        (rng.choice(["x", "y", None]), rng.randrange(3), rng.choice([1, None]), rng.choice([None, 1, 2, 3, rng.randrange(40)]), rng.randrange(9))
        for _ in range(300)
    ]
    # a third of all rows are one order's
    rows += [("x", 1, 1, 7, 1)] * 150
    frame = spark.createDataFrame(rows, "a string, b int, c int, id long, v long")
    columns = list(dict.fromkeys(c for s in sets for c in s))
    got = grouping_levels(frame, sets, "id", "v", columns)
    frame.createOrReplaceTempView("levels_of")
    groups = ", ".join(f"({', '.join(s)})" for s in dict.fromkeys(map(tuple, sets)))
    want = spark.sql(
        f"SELECT {', '.join(columns)}, CAST(grouping_id({', '.join(columns)}) AS long), sum(v), count(DISTINCT id)"
        f" FROM levels_of GROUP BY GROUPING SETS ({groups})"
    )
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    text = plan(got).split("Initial Plan")[0]
    # Rows are laid out per level only behind the reduction by order, and that shuffles three times in all.
    assert text.count("Exchange ") == 3 and text.index("Generate") < text.index("HashAggregate", text.index("Generate"))


def test_rows_that_two_tables_do_not_share(spark):
    left = [(1, "a"), (1, "a"), (2, "b"), (3, None), (4, "x"), (None, "n"), (None, "n"), (6, "s")]
    right = [(1, "a"), (2, "b"), (3, None), (4, "y"), (5, "new"), (None, "n"), (6, "s"), (6, "s")]
    frames = [spark.createDataFrame(rows, "k long, v string") for rows in (left, right)]
    found = row_difference(*frames, "k", ["k", "v"])
    got = {r.k: (r.left_rows, r.right_rows, r.equal_rows, r.only_left, r.only_right) for r in found.collect()}
    assert got == {
        1: (2, 1, 1, 1, 0), 4: (1, 1, 0, 1, 1), 5: (0, 1, 0, 0, 1), None: (2, 1, 1, 1, 0), 6: (1, 2, 1, 0, 1),
    }
    extra = frames[0].exceptAll(frames[1]).count()
    assert extra == sum(v[3] for v in got.values())


def test_a_row_sent_very_often_crosses_the_shuffle_once_per_task(spark):
    often = spark.range(0, 30000, 1, 4).select(F.lit(1).cast("long").alias("k"), F.lit("same").alias("v"))
    found = row_difference(often, often.limit(1), "k", ["k", "v"])
    assert tuple(found.first()) == (1, 30000, 1, 1, 29999, 0)
    # Both aggregations combine in their tasks ahead of their shuffle.
    assert plan(found).split("Initial Plan")[0].count("partial_sum(_l") == 2
