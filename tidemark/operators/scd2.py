"""Type-2 dimension refresh."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.entities import ENTITIES, PLAIN, Dimension, dimension_schema
from tidemark.functions.typing_rules import moment
from tidemark.operators.numbering import highest


def differs(dim: Dimension, null_safe: bool = False) -> str:
    """Whether the joined source row (``_new_*``) changes a tracked column of the version."""
    entity = ENTITIES[dim.entity]
    tests = []
    for name, mode in dim.tracked:
        if null_safe:
            tests.append(f"NOT ({name} <=> _new_{name})")
        elif mode is PLAIN:
            tests.append(f"{name} <> _new_{name}")
        else:
            stand_in = f"CAST('{mode}' AS {entity.column(name).data_type.simpleString()})"
            tests.append(f"coalesce({name}, {stand_in}) <> coalesce(_new_{name}, {stand_in})")
    return f"coalesce({' OR '.join(tests)}, false)"


def scd2_step(
    current: DataFrame,
    source: DataFrame,
    dim: Dimension,
    batch_ts: datetime,
    base: Column | int,
    null_safe: bool = False,
) -> DataFrame:
    """Compare current versions with the clean table and return what replaces them.

    One join by business key. Each joined pair yields one or two rows: the kept version, or the
    closed version and its successor, or the first version of a new key. A new version is numbered
    ``base`` plus the clean row's own surrogate: unique within the batch, above all earlier numbers,
    and free of any shuffle.
    """
    entity = ENTITIES[dim.entity]
    key, names = entity.key, dimension_schema(dim).fieldNames()
    start = F.lit(base) if isinstance(base, int) else base
    right = source.selectExpr(
        key, f"{entity.surrogate} AS _number", *[f"{c} AS _new_{c}" for c in dim.carried]
    ).withColumn("_number", F.col("_number") + start)

    def row(values: dict[str, str], otherwise: str) -> str:
        fields = [f"{values.get(c, otherwise + c)} AS {c}" for c in names]
        return f"struct({', '.join(fields)})"

    kept = row({}, "")
    closed = row({"eff_end_date": moment(batch_ts), "is_current": "false"}, "")
    opened = row(
        {
            dim.surrogate: "_number",
            key: key,
            "eff_start_date": moment(batch_ts),
            "eff_end_date": "CAST(NULL AS timestamp_ntz)",
            "is_current": "true",
        },
        "_new_",
    )
    return (
        current.select(*names)
        .join(right, key, "full_outer")
        .selectExpr(
            f"inline(CASE WHEN {dim.surrogate} IS NULL THEN array({opened})"
            f" WHEN _number IS NOT NULL AND {differs(dim, null_safe)} THEN array({closed}, {opened})"
            f" ELSE array({kept}) END)"
        )
        # Expressions drop the column tags.
        .to(dimension_schema(dim))
    )


def scd2(
    table: DataFrame,
    source: DataFrame,
    dim: Dimension,
    batch_ts: datetime,
    null_safe: bool = False,
) -> DataFrame:
    """The whole dimension after the batch: closed history untouched, current versions refreshed."""
    table = table.select(*dimension_schema(dim).fieldNames())
    current = table.filter("is_current")
    step = scd2_step(current, source, dim, batch_ts, highest(table, dim.surrogate), null_safe)
    return table.filter("NOT is_current").unionByName(step).to(dimension_schema(dim))
