"""Which rows two tables do not share, with multiplicity, by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.entities import Entity
from tidemark.operators.clean import type_rows

KINDS = ("without a key", "missing", "not staged", "repeated", "changed", "surplus")


def row_difference(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key whose rows differ: how many each side has, how many are equal in all ``columns``,
    and how many only one side has (``EXCEPT ALL`` both ways).

    Both sides are reduced to counts per (key, digest) in the tasks that read them, so a row sent a million
    times crosses the shuffle once per task, and a key with very many different rows is spread by digest. Equal means
    equal with NULL equal to NULL; digests have 128 bits, as two numbers, which are half as long as hex digits
    and keep the counted rows at a fixed width.
    """
    digest = F.md5(F.to_json(F.struct(*[c for c in columns if c != key] or [key])))

    def counted(rows: DataFrame, left_count: int) -> DataFrame:
        sides = (F.lit(left_count).cast("long").alias("_l"), F.lit(1 - left_count).cast("long").alias("_r"))
        half = [F.conv(F.substring("_digest", at, 16), 16, -10).cast("long") for at in (1, 17)]
        rows = rows.select(F.col(key), digest.alias("_digest"))
        return rows.select(key, half[0].alias("_high"), half[1].alias("_low"), *sides)

    both = counted(left, 1).unionByName(counted(right, 0))
    rows = both.groupBy(key, "_high", "_low").agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    zero = F.lit(0).cast("long")
    return (
        rows.groupBy(key)
        .agg(
            F.sum("_l").alias("left_rows"),
            F.sum("_r").alias("right_rows"),
            F.sum(F.least("_l", "_r")).alias("equal_rows"),
            F.sum(F.greatest(F.col("_l") - F.col("_r"), zero)).alias("only_left"),
            F.sum(F.greatest(F.col("_r") - F.col("_l"), zero)).alias("only_right"),
        )
        .filter("only_left > 0 OR only_right > 0")
    )


def layer_difference(stage: DataFrame, clean: DataFrame, entity: Entity) -> DataFrame:
    """The keys for which stage and clean rows of an entity do not agree, and how.

    Stage rows are compared as they are typed. ``without a key``: stage rows whose key cannot be read, all in
    one row. ``missing``: staged, not in the clean table. ``not staged``: the other way round. ``repeated``: the
    clean row is there, and the stage holds it again or other versions of it. ``changed``: no stage row is equal
    to the clean one. ``surplus``: the clean table holds more copies than the stage.
    """
    columns = [c.name for c in entity.columns]
    found = row_difference(type_rows(stage, entity), clean, entity.key, columns)
    kind = (
        F.when(F.col(entity.key).isNull(), "without a key")
        .when(F.col("right_rows") == 0, "missing")
        .when(F.col("left_rows") == 0, "not staged")
        .when(F.col("only_right") == 0, "repeated")
        .when(F.col("only_left") > 0, "changed")
        .otherwise("surplus")
    )
    return found.select(
        F.col(entity.key).alias("key"),
        F.col("left_rows").alias("stage_rows"),
        F.col("right_rows").alias("clean_rows"),
        "equal_rows",
        F.col("only_left").alias("only_in_stage"),
        F.col("only_right").alias("only_in_clean"),
        kind.alias("kind"),
    )
