"""Surrogate keys without a global sort or a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Numbers of lanes handed out to hashed keys. Fixed, so that no setting of a session changes a number;
#: many, so that each is a short sort and any number of tasks can share them. A load of more than LANE_ROWS rows a
#: lane takes more of them.
LANES, LANE_ROWS = 4096, 250_000


def lanes_for(rows: int, least: int = LANES) -> int:
    """Lanes for a load of so many rows: numbers depend on how many rows there are, not on the cluster."""
    lanes = least
    while lanes * LANE_ROWS < rows:
        lanes *= 2
    return lanes


def lane_of(key: str, lanes: int) -> str:
    """SQL for the lane of a key. Where lanes are a multiple of a table's buckets, a lane is a part of one bucket."""
    return f"pmod(xxhash64({key}), {lanes}L)"


def number_rows(
    rows: DataFrame, key: str, name: str, base: Column | int = 0, lanes: int = LANES, within: str | None = None
) -> DataFrame:
    """Add ``name``: a unique number above ``base`` for each row of a frame with unique ``key``.

    Keys are hashed into lanes, rows are counted inside their lane in key order, and lane ``i`` of
    ``n`` hands out ``i+1, i+1+n, i+1+2n, ...`` above the base. The numbers depend on the keys only,
    so a task that is run again hands out the same ones, and no lane needs another lane's size. Loads
    may differ in their lanes, as each begins above all numbers handed out before (``lanes_for``).
    ``within`` is a column that a lane has one value of; a task's rows are then in its order.
    """
    lane = lane_of(key, lanes)
    parts = lane if within is None else f"{within}, {lane}"
    number = (
        f"(row_number() OVER (PARTITION BY {parts} ORDER BY {key}) - 1L) * {lanes}L + {lane} + 1L"
    )
    if isinstance(base, int):
        return rows.selectExpr("*", f"{base}L + {number} AS {name}")
    return rows.selectExpr("*", f"{number} AS {name}").withColumn(name, F.col(name) + base)


def highest(table: DataFrame, name: str) -> Column:
    """The largest number handed out so far, as a scalar subquery; 0 for an empty table."""
    return table.selectExpr(f"coalesce(max({name}), 0L)").scalar()
