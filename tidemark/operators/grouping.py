"""ROLLUP, CUBE and GROUPING SETS with exact distinct counts, from rows that are reduced first.

An order can fall in several groups of the finest level and must count once on every coarser one, so the counts of
the levels cannot be added up. The rows are reduced to one per group and order and dealt out by order; there the first
row of an order in a group of each level is marked, by sorts that spill and hold each row once. Only what is added up
is then laid out once per level, and a level's groups are few.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Sets = Sequence[Sequence[str]]


def rollup_sets(columns: Sequence[str]) -> Sets:
    """All columns, then one less at the end, down to none."""
    return [columns[:n] for n in range(len(columns), -1, -1)]


def cube_sets(columns: Sequence[str]) -> Sets:
    """All subsets."""
    return [c for n in range(len(columns), -1, -1) for c in combinations(columns, n)]


def _chains(sets: Iterable[frozenset[str]]) -> list[list[frozenset[str]]]:
    """The sets in chains, in each of which a set holds the next."""
    left, chains = sorted(sets, key=len, reverse=True), []
    while left:
        chain = [left.pop(0)]
        for s in list(left):
            if s < chain[-1]:
                chain.append(s)
                left.remove(s)
        chains.append(chain)
    return chains


def grouping_levels(
    rows: DataFrame, sets: Sets, counted: str, summed: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per group of each set: its columns (NULL where the set lacks one), ``grouping_id``, ``total``
    (the sum of ``summed``) and ``distinct_count`` (different values of ``counted``, NULL left out).

    ``grouping_id`` has a bit per column, the first one highest, set where the column is not in the set; so
    a NULL of the data is told from a column that is left out. Sets that occur twice count once. Without rows
    there are no groups, that of the set without columns included.
    """
    if columns is None:
        columns = list(dict.fromkeys(c for s in sets for c in s))
    columns = list(columns)
    numbers = {sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s): s for s in sets}
    # A hot order is combined in its tasks and then has a row per group at most.
    per_order = rows.groupBy(*columns, counted).agg(F.sum(summed).alias("_sum")).repartition(counted)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    # The first row of an order in each of its groups counts it there. The sets of a chain are prefixes of one order
    # of columns, so a single sort of the rows of an order serves them all, and no set needs rows of its own.
    marked, first = per_order, {}
    for chain in _chains([frozenset(s) for s in numbers.values()]):
        ordered = sorted(columns, key=lambda c: (sum(c not in s for s in chain), columns.index(c)))
        for members in chain:
            group, rest = ordered[: len(members)], ordered[len(members) :]
            window = Window.partitionBy(counted, *group).orderBy(*rest) if rest else None
            first[members] = name = f"_first{len(first)}"
            # In the finest groups an order has one row. One column at a time: the windows of a chain stay side by side.
            place = F.lit(1) if window is None else F.row_number().over(window)
            marked = marked.withColumn(name, (F.col(counted).isNotNull() & (place == 1)).cast("long"))

    def level(number: int, members: Sequence[str]) -> str:
        shown = [c if c in members else f"CAST(NULL AS {kinds[c]})" for c in columns]
        fields = ", ".join(f"{value} AS _{i}" for i, value in enumerate(shown))
        return f"struct({number}L AS grouping_id, {first[frozenset(members)]} AS _first{', ' + fields if fields else ''})"

    levels = ", ".join(level(n, s) for n, s in numbers.items())
    laid_out = marked.selectExpr("_sum", f"inline(array({levels}))")
    names = ["grouping_id", *[f"_{i}" for i in range(len(columns))]]
    found = laid_out.groupBy(*names).agg(F.sum("_sum").alias("total"), F.sum("_first").alias("distinct_count"))
    renamed = [F.col(f"_{i}").alias(c) for i, c in enumerate(columns)]
    return found.select(*renamed, "grouping_id", "total", "distinct_count")
