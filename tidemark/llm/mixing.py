"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, hex60, stored

#: Rows of a cell, the unit that one task sorts; a source has as many cells as its share needs.
CELL_ROWS = 2_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: Sequence[int], limit: int) -> DataFrame:
    """What each source gives: (absent, name, source_size) with target and budget, one row per source.

    The sources, in order of their names with the one without a name last, weigh ``weights`` over and
    over and share the sum of all sizes. None gives more than ``limit`` times its own size; what it
    cannot give goes to the others by weight. That is one level: sources of a ratio of limit to weight
    below it give their limit, the others the level times their weight.
    """
    by_name = Window.orderBy("absent", "name")
    by_ratio = Window.orderBy("ratio", "absent", "name")
    ahead = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    behind = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(
        F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    )
    everyone = Window.partitionBy()
    ranked = totals.withColumn("weight", weight).withColumn("cap", limit * F.col("source_size"))
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    left = F.sum("source_size").over(everyone) - F.coalesce(F.sum("cap").over(ahead), F.lit(0))
    ranked = ranked.withColumn("level_here", left / F.sum("weight").over(behind))
    first = F.min(F.when(F.col("level_here") <= F.col("ratio"), F.struct("ratio", "absent", "name", "level_here")))
    level = first.over(everyone)["level_here"]
    target = F.least(F.col("cap").cast("double"), level * F.col("weight"))
    return (
        ranked.withColumn("target", target)
        .withColumn("budget", F.least("cap", F.floor(F.col("target") + 0.5)).cast("long"))
        .select("absent", "name", "source_size", "target", "budget")
    )


def mixture(
    docs: DataFrame,
    size: Column,
    doc_id: str = "doc_id",
    source: str = "source",
    into: str = "mix",
    weights: Sequence[int] = (5, 2, 1),
    limit: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with a struct column ``into``: size, source_size, target, taken.

    The rows of a source are ordered by a hash of seed and doc_id, which any rerun repeats (equal
    hashes by doc_id, nulls last, then by size). A source is taken whole as often as its budget
    holds it and then, in that order, up to its budget to the unit; so one row of a source may be
    taken in part. Prefix sums are those of cells of the hash range plus those inside a cell, so no
    task sorts a whole source, however hot. A null source is a source of its own, the last one; a
    null size counts as zero. An input column called ``into`` is replaced, others pass through.
    """
    rest = [c for c in docs.columns if c.lower() != into.lower()]
    name = F.col(f"`{source}`")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"),
        F.col(f"`{doc_id}`").alias("id"),
        name.isNull().alias("absent"),
        F.coalesce(name, F.lit("")).alias("name"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        hex60(F.lit(seed + ":"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("-"))).alias("key"),
    )
    count = docs.count()
    bits = max(0, min(40, (count // CELL_ROWS).bit_length()))
    rows = rows.withColumn("cell", F.shiftright("key", 60 - bits))
    place = ["absent", "name", "cell"]
    cells = stored(rows.groupBy(*place).agg(F.sum("size").alias("cell_size")), "mix-cells")
    totals = cells.groupBy("absent", "name").agg(F.sum("cell_size").alias("source_size"))
    before = Window.partitionBy("absent", "name").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("cell_before", F.coalesce(F.sum("cell_size").over(before), F.lit(0)))
    cells = cells.join(targets(totals, weights, limit), ["absent", "name"]).drop("cell_size")
    inside = (
        Window.partitionBy(*place)
        .orderBy("key", F.col("id").asc_nulls_last(), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.join(cells, place).withColumn(
        "ahead", F.col("cell_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    # An empty source has nothing to repeat.
    per = F.greatest("source_size", F.lit(1))
    rounds, over = F.expr("budget DIV greatest(source_size, 1L)"), F.col("budget") % per
    last = F.greatest(F.lit(0), F.least(F.col("size"), over - F.col("ahead")))
    result = placed.select(
        "row",
        F.struct("size", "source_size", "target", (rounds * F.col("size") + last).alias("taken")).alias("mix"),
    )
    return result.select(*[F.col(f"row.`{c}`") for c in rest], F.col("mix").alias(into))


def mixed_texts(docs: DataFrame, text: str = "text", length: str = "n_chars", **options: object) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each time a text is taken.

    The text that meets its source's budget is cut after so many words (joined by one space), and
    ``length`` is its new length. A text without words has nothing to take and is left out.
    """
    into = "_mix"
    while into in docs.columns:
        into += "_"
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(WORD), 0)
    mix = mixture(docs, word_count(F.col(f"`{text}`")), into=into, **options)
    taken, size = F.col(f"{into}.taken"), F.col(f"{into}.size")
    rounds = F.sequence(F.lit(0), F.expr(f"({into}.taken - 1) DIV {into}.size"))
    parts = F.transform(rounds, lambda i: F.least(size, taken - i * size).cast("int"))
    mix = mix.filter(taken > 0).withColumn(into, F.explode(parts))
    shorter = F.col(into) < word_count(F.col(f"`{text}`"))
    cut = F.array_join(F.slice(words, 1, F.col(into)), " ")
    columns = {c: F.col(f"`{c}`") for c in docs.columns}
    if length in columns:
        kind = docs.schema[length].dataType
        columns[length] = F.when(shorter, F.length(cut).cast(kind)).otherwise(columns[length])
    columns[text] = F.when(shorter, cut).otherwise(columns[text])
    return mix.select(*[column.alias(c) for c, column in columns.items()])
