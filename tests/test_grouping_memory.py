"""Levels count distinct orders without holding a row per level, whichever sets are asked for."""

from decimal import Decimal
from itertools import product

import pytest

from tidemark.operators.grouping import cube_sets, grouping_levels, rollup_sets

COLUMNS = ("a", "b", "c")
ROWS = [(o, a, b, c, Decimal(1)) for o, a, b, c in product((1, 2, None), ("x", None), ("y", "z"), ("u", "v")) if (o, a) != (2, "x")]


@pytest.mark.parametrize("sets", [cube_sets(COLUMNS), rollup_sets(COLUMNS), [("a", "c"), ("b",), ("c", "b")]])
def test_levels_equal_plain_grouping_sets(spark, sets):
    rows = spark.createDataFrame(ROWS * 2, "o long, a string, b string, c string, v decimal(10,2)")
    rows.createOrReplaceTempView("level_rows")
    listed = ", ".join(f"({', '.join(s)})" for s in sets)
    plain = spark.sql(
        "SELECT a, b, c, grouping_id(a, b, c) AS g, sum(v) AS t, count(DISTINCT o) AS n FROM level_rows"
        f" GROUP BY a, b, c GROUPING SETS ({listed})"
    )
    found = grouping_levels(rows, sets, "o", "v", COLUMNS)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, map(tuple, plain.collect())))


def test_levels_sort_once_per_chain_and_keep_no_row_per_level(spark):
    rows = spark.createDataFrame(ROWS, "o long, a string, b string, c string, v decimal(10,2)")
    found = grouping_levels(rows, cube_sets(COLUMNS), "o", "v", COLUMNS)
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # Above the rows that are laid out per level there is only the sum by group, of which there are few.
    above = plan[: plan.index("Generate")]
    assert above.count("HashAggregate") == 2 and above.count("Exchange") == 1
    assert plan.count("Sort [") == 3
