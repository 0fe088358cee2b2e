"""Ranks in groups of any size: sampled range splitters put rows in order, and counts per range add up.

No window sees a whole group: one counts inside a range, another adds up one row per range and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import splittable_join
from tidemark.sources.shared import scratch, written

#: Rows of a range, on average.
RANGE_ROWS = 500_000


def _counted(rows: DataFrame, group: str, order: list[Column], weight: str) -> DataFrame:
    """``rows`` with ``_before`` (the sum of ``weight`` of the rows ahead in the group), ``_ahead`` (their number),
    and ``_total`` and ``_many`` for the whole group, if they are ordered by ``group`` and then ``order``."""
    spark = rows.sparkSession
    rows = written(rows, scratch(spark, "ranking"))
    parts = max(1, -(-rows.count() // RANGE_ROWS))
    by = [F.col(group), *order]
    ranged = rows.repartitionByRange(parts, *by).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, scratch(spark, "ranges"))
    cells = ranged.groupBy("_part", group).agg(F.sum(weight).alias("_w"), F.count("*").alias("_n"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        F.col("_part").alias("_in"),
        F.col(group).alias("_of"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(a) for c, a in (("_w", "_w0"), ("_n", "_n0"))],
        *[F.sum(c).over(whole).alias(a) for c, a in (("_w", "_total"), ("_n", "_many"))],
    )
    met = ranged.join(cells, (F.col("_part") == F.col("_in")) & F.col(group).eqNullSafe(F.col("_of")))
    inside = Window.partitionBy("_part", group).orderBy(*by[1:]).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_w0") + F.coalesce(F.sum(weight).over(inside), F.lit(0))
    ahead = F.col("_n0") + F.count("*").over(inside)
    return met.select(*rows.columns, before.alias("_before"), ahead.alias("_ahead"), "_total", "_many")


def ranked(rows: DataFrame, group: str, value: str, key: str, tiles: int, descending: bool = True) -> DataFrame:
    """``rows`` with ``row_number``, ``rank``, ``dense_rank``, ``percent_rank`` and ``tile`` (NTILE) in their group.

    The order is by ``value``, greatest first (NULL last) unless told otherwise (then NULL first), and by ``key``,
    which tells rows of a group apart, as only then the first and the last of these are certain. A NULL group
    is a group.
    """
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    values = rows.groupBy(group, value).agg(F.count("*").alias("_weight"))
    values = _counted(values, group, [order], "_weight").selectExpr(
        f"{group} AS _of", f"{value} AS _at", "_before + 1 AS rank", "_ahead + 1 AS dense_rank"
    )
    numbered = _counted(rows.withColumn("_one", F.lit(1).cast("long")), group, [order, F.col(key)], "_one")
    # A join finds no NULL, so whether there is a value is part of the key.
    keyed = [f"struct({{0}} IS NULL AS n, {{0}} AS v) AS {name}" for name in ("_g", "_v")]
    left = numbered.selectExpr("*", keyed[0].format(group), keyed[1].format(value))
    right = values.selectExpr("rank", "dense_rank", keyed[0].format("_of"), keyed[1].format("_at"))
    same = ["_g", "_v"]
    text = [F.to_json(F.col(c)).alias(c) for c in same]
    left = left.select(*[c for c in left.columns if c not in same], *text)
    right = right.select("rank", "dense_rank", *text)
    met = splittable_join(left, right, same)
    small, large = "_many DIV {t}".format(t=tiles), "_many % {t}".format(t=tiles)
    tile = (
        f"CASE WHEN _ahead < ({large}) * ({small} + 1) THEN _ahead DIV ({small} + 1)"
        f" ELSE ({large}) + (_ahead - ({large}) * ({small} + 1)) DIV greatest({small}, 1L) END + 1"
    )
    return met.selectExpr(
        *rows.columns,
        "_ahead + 1 AS row_number",
        "rank",
        "dense_rank",
        "CASE WHEN _many > 1 THEN (rank - 1) / (_many - 1) ELSE 0D END AS percent_rank",
        f"{tile} AS tile",
    )
