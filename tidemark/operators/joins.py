"""Joins whose hot keys can be split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that a filter may list; beyond that number rows are joined.
LISTED = 10_000


def splittable_join(left: DataFrame, right: DataFrame, key: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join by ``key`` (one column or several) where the left side may hold a key very many times.

    Adaptive execution splits a hot key only if both inputs are shuffled for this very join, and not
    if one of them happens to be partitioned by the key already. The lane, which follows from the key
    and so changes nothing in the result, makes the join ask for a partitioning no input has.
    """
    keys = [key] if isinstance(key, str) else list(key)
    lane = f"pmod(xxhash64({', '.join(keys)}), 1024L) AS _lane"
    joined = left.selectExpr("*", lane).join(right.selectExpr("*", lane), [*keys, "_lane"], how)
    return joined.drop("_lane")


def not_broadcast(rows: DataFrame) -> DataFrame:
    """Rows for one side of a join that may be many, though their files are small.

    Spark takes a few columns of a stored table for that share of its compressed files, which is far less than the
    rows take in memory; millions of keys would so be gathered by the driver.
    """
    return rows.hint("merge")


def rows_with(left: DataFrame, keys: DataFrame, key: str, listed: int = LISTED) -> DataFrame | None:
    """The rows of ``left`` whose ``key`` is in ``keys``; None if there is no key at all.

    Few keys become a filter, which reaches the scan and shuffles nothing; ``listed`` bounds how many
    are looked at for that. More are joined as a semi join that can be split.
    """
    keys, found = _looked_at(keys, key, listed)
    if len(found) > listed:
        return splittable_join(left, keys, key, "left_semi")
    return left.filter(F.col(key).isin(found)) if found else None


def marked(left: DataFrame, keys: DataFrame, key: str, name: str, listed: int = LISTED) -> DataFrame:
    """All rows of ``left``, with a column ``name`` that is true where their ``key`` is in ``keys``.

    For few keys it is plain enough that a filter on it reaches the scan.
    """
    keys, found = _looked_at(keys, key, listed)
    if len(found) > listed:
        return splittable_join(left, keys.withColumn(name, F.lit(True)), key, "left")
    return left.withColumn(name, F.col(key).isin(found) if found else F.lit(False))


def _looked_at(keys: DataFrame, key: str, listed: int) -> tuple[DataFrame, list]:
    """The different keys, and up to ``listed`` and one of them."""
    keys = keys.select(key).distinct()
    return keys, [r[0] for r in keys.limit(listed + 1).collect()]
