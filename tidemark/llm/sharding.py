"""Sharding by sampled splitters: ranges of near equal bytes, overfull ones subdivided.

What has to be put in order is first reduced to one row per key, then to one per (key, key2); only the places
inside those are counted row by row. So a key, or a row, that a third of the table repeats is a single row
where order is made, and its rows are dealt out where they are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import count_below, hex60, stored
from tidemark.operators.joins import splittable_join

#: Ranges that the sample cuts, rows drawn for each, and rows that one cell has on average at most.
RANGES, DRAWN, CELL_ROWS = 256, 16, 20_000
#: A group of equal keys stays in one shard unless it has more than this share of a shard's bytes.
GROUP_SHARE = 0.05
_SPAN = 1 << 60


def splitters(rows: DataFrame, total: int) -> list[int]:
    """Quantile boundaries of ``key`` by ``size``, from a sample that is drawn in proportion to size.

    The draw depends on the rows only. Its expected number is RANGES * DRAWN, whatever the table
    holds; that many numbers reach the driver. A key that fills a range alone occurs repeatedly and
    is given once.
    """
    chance = F.col("size") * (RANGES * DRAWN / max(1, total))
    luck = hex60(F.lit("draw:"), F.col("key").cast("string"), F.lit(":"), F.col("key2").cast("string")) / _SPAN
    drawn = rows.select("key", F.floor(chance + luck).cast("int").alias("times")).filter("times > 0")
    keys = sorted((r.key, r.times) for r in drawn.groupBy("key").agg(F.sum("times").alias("times")).collect())
    found, passed = [], 0
    for key, times in keys:
        if (passed + times) // DRAWN > passed // DRAWN:
            found.append(key)
        passed += times
    return found


def _range_of(key: Column, cuts: list[int]) -> Column:
    """Twice the number of splitters below the key, plus one if it equals the next one."""
    if not cuts:
        return F.lit(0)
    every, below = F.array(*[F.lit(c).cast("long") for c in cuts]), count_below(key, cuts)
    return 2 * below + F.coalesce((F.get(every, below) == key).cast("int"), F.lit(0))


def _cells(rows: DataFrame, by: str, bytes_: str, count: str, order: str) -> DataFrame:
    """``rows`` with ``bytes_ahead`` and ``rows_ahead``: sums of what comes before them in their ``by``.

    The rows of a ``by`` are in cells ``part``, whose sums are put in order first.
    """
    cells = rows.groupBy(by, "part").agg(F.sum(bytes_).alias("_b"), F.sum(count).alias("_c"))
    earlier = Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(by, "part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("_b", "_c")])
    inside = Window.partitionBy(by, "part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = [
        (F.col(cell) + F.coalesce(F.sum(own).over(inside), F.lit(0))).alias(name)
        for cell, own, name in (("_b", bytes_, "bytes_ahead"), ("_c", count, "rows_ahead"))
    ]
    return rows.join(cells, [by, "part"]).select(*rows.columns, *ahead)


def _parts(value: Column, low: Column, high: Column, parts: Column) -> Column:
    """Which of ``parts`` equal pieces of [low, high) a value is in."""
    return F.greatest(F.lit(0), F.least(parts - 1, F.floor((value - low) / (high - low) * parts)))


def _placed_keys(keys: DataFrame, cuts: list[int]) -> DataFrame:
    """``keys`` (key, group_size, group_rows and others) with the bytes and rows ahead of each."""
    keys = keys.withColumn("range", _range_of(F.col("key"), cuts))
    ranges = keys.groupBy("range").agg(
        F.min("key").alias("low"),
        F.max("key").alias("high"),
        F.ceil(F.count("*") / CELL_ROWS).alias("parts"),
        F.sum("group_size").alias("range_bytes"),
        F.sum("group_rows").alias("range_rows"),
    )
    # As many rows as the sample has splitters, twice.
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "range",
        "low",
        "high",
        "parts",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("range_bytes", "range_rows")],
    )
    part = _parts(F.col("key"), F.col("low"), F.col("high") + 1, F.col("parts"))
    celled = keys.join(ranges, "range").withColumn("part", part)
    found = _cells(celled, "range", "group_size", "group_rows", "key")
    return found.select(
        *[c for c in keys.columns if c != "range"],
        (F.col("range_bytes") + F.col("bytes_ahead")).alias("group_start"),
        (F.col("range_rows") + F.col("rows_ahead")).alias("group_number"),
    )


def sharded(rows: DataFrame, shards: int = 40) -> DataFrame:
    """``rows`` (size, key, key2 and what else they carry) with ``shard`` and ``slot``.

    The law is ``bytes``: shards are consecutive ranges of (key, key2, size) of near equal sums of ``size``. A
    record goes where the middle of its own bytes falls. Equal keys go together, where the middle of all their
    bytes falls, if they have at most GROUP_SHARE of a shard's bytes, however many they are; a larger group is
    cut like single records, as one shard could not hold it. ``slot`` counts a shard's rows from 0 without gaps.

    Ranges from sampled splitters spread the work; one with more than CELL_ROWS keys is subdivided, and so are
    a key with more rows and a row that is repeated more often. Bytes and rows ahead are exact sums, so the
    result does not depend on the sample. ``key`` and ``key2`` lie in 0 to 2**60. Rows equal in all three are
    rows of their own, told apart by their place in ``rows``, which should be a stored table. Columns of any
    name are carried; ``shard`` and ``slot`` are replaced. NULL in other columns means nothing here, size and
    keys are not NULL. No rows give no rows.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    records = rows.select("size", "key", "key2", F.monotonically_increasing_id().alias("own"), carried.alias("row"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    cuts = splitters(rows, total)
    alike = ["key", "key2", "size"]
    pairs = records.groupBy(*alike).agg(F.count("*").alias("copies"), F.sum("size").alias("bytes"))
    pairs = stored(pairs, "shard-pairs")
    keys = pairs.groupBy("key").agg(
        F.sum("bytes").alias("group_size"), F.sum("copies").alias("group_rows"), F.ceil(F.count("*") / CELL_ROWS).alias("pieces")
    )
    keys = _placed_keys(keys, cuts)
    met = splittable_join(pairs, keys, "key").withColumn("order", F.struct("key2", "size"))
    met = met.withColumn("part", _parts(F.col("key2"), F.lit(0), F.lit(_SPAN), F.col("pieces")))
    met = _cells(met, "key", "bytes", "copies", "order").select(
        *alike,
        "copies",
        "group_start",
        "group_size",
        (F.col("group_start") + F.col("bytes_ahead")).alias("start"),
        (F.col("group_number") + F.col("rows_ahead")).alias("number"),
    )
    placed = _numbered(splittable_join(records, met, alike), alike)
    whole = F.col("group_size") * shards <= GROUP_SHARE * total
    twice_middle = F.when(whole, 2 * F.col("group_start") + F.col("group_size")).otherwise(
        2 * (F.col("start") + F.col("index") * F.col("size")) + F.col("size")
    )
    shard = F.least(F.lit(shards - 1), F.floor(twice_middle * shards / (2 * max(1, total)))).cast("int")
    placed = placed.select("row", shard.alias("shard"), (F.col("number") + F.col("index")).alias("number"))
    placed = stored(placed, "shards")
    first = placed.groupBy("shard").agg(F.min("number").alias("first"))
    # One row per shard, so its size is bounded by the argument.
    found = placed.join(F.broadcast(first), "shard")
    shown = [F.col(f"row.`{c}`") for c in rows.columns if c.lower() not in ("shard", "slot")]
    return found.select(*shown, "shard", (F.col("number") - F.col("first")).alias("slot"))


def _numbered(records: DataFrame, alike: list[str]) -> DataFrame:
    """``records`` with ``index``, which counts those that are ``alike`` from 0; many are counted in parts."""
    part = F.pmod(F.col("own"), F.ceil(F.col("copies") / CELL_ROWS)).alias("part")
    records = records.select("*", part)
    many = records.filter(F.col("copies") > CELL_ROWS).groupBy(*alike, "part").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy(*alike).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    many = many.select(*alike, "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(Window.partitionBy(*alike, "part").orderBy("own")) - 1
    counted = records.withColumn("index", inside).join(many, [*alike, "part"], "left")
    return counted.withColumn("index", F.col("index") + F.coalesce("earlier", F.lit(0)))
