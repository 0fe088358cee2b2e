"""Stage text to typed rows: projection, required-column guard, last row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.entities import AUDIT_SCHEMA, Entity
from tidemark.functions.typing_rules import beyond_key, typed
from tidemark.sources.text_csv import MALFORMED


def type_rows(stage: DataFrame, entity: Entity) -> DataFrame:
    """The typed projection of a stage frame, one row out per row in, with the column tags."""
    values = [f"{typed(c)} AS {c.name}" for c in entity.columns]
    rows = stage.selectExpr(*values, *AUDIT_SCHEMA.fieldNames())
    fields = entity.clean_schema().fields
    return rows.to(T.StructType([f for f in fields if f.name != entity.surrogate]))


def faults(stage: DataFrame, entity: Entity) -> str:
    """SQL for why a stage row cannot be loaded; NULL if it can.

    A malformed line is reported as such, whatever its fields seem to hold. Otherwise each required
    column that stays empty is named, and apart from those each key whose number is too large.
    """
    keys = [c for c in entity.columns if c.kind == "key" and c.required]
    large = ", ".join(f"CASE WHEN {beyond_key(c.stage)} THEN '{c.name}' END" for c in keys)
    empty = ", ".join(
        f"CASE WHEN {typed(c)} IS NULL"
        + (f" AND NOT coalesce({beyond_key(c.stage)}, false)" if c in keys else "")
        + f" THEN '{c.name}' END"
        for c in entity.columns
        if c.required
    )
    reasons = [
        f"concat('missing: ', nullif(concat_ws(',', {empty}), ''))",
        f"concat('out of range: ', nullif(concat_ws(',', {large}), ''))",
    ]
    reason = f"nullif(concat_ws('; ', {', '.join(reasons)}), '')"
    if MALFORMED in stage.columns:
        reason = f"CASE WHEN {MALFORMED} IS NOT NULL THEN 'malformed line' ELSE {reason} END"
    return reason


def loadable(stage: DataFrame, entity: Entity) -> str:
    """SQL for whether a stage row has no faults, without the work of naming them; never NULL."""
    tests = [f"({typed(c)}) IS NOT NULL" for c in entity.columns if c.required]
    if MALFORMED in stage.columns:
        tests.insert(0, f"{MALFORMED} IS NULL")
    return f"({' AND '.join(tests)})"


def split_required(stage: DataFrame, entity: Entity) -> tuple[DataFrame, DataFrame]:
    """Typed rows that can be loaded, and the others with the reason."""
    reason = faults(stage, entity)
    accepted = type_rows(stage.filter(loadable(stage, entity)), entity)
    marked = stage.filter(f"NOT {loadable(stage, entity)}").withColumn("_reason", F.expr(reason))
    values = [f"{typed(c)} AS {c.name}" for c in entity.columns]
    rejected = marked.selectExpr(*values, *AUDIT_SCHEMA.fieldNames(), "_reason AS reject_reason")
    return accepted, rejected.to(reject_schema(entity))


def reject_schema(entity: Entity) -> T.StructType:
    fields = [f for f in entity.clean_schema().fields if f.name != entity.surrogate]
    return T.StructType([*fields, T.StructField("reject_reason", T.StringType())])


def last_per_key(rows: DataFrame, key: str) -> DataFrame:
    """The most recently copied row of each key.

    Within one copy the later file counts, by its own time and then by its name; what still ties falls
    to the remaining columns, so the choice does not depend on row order. The rank filter becomes a
    per-task limit ahead of the shuffle, so a key that was sent many times reaches the shuffle once
    per task.
    """
    age = [c for c in ("_copy_ts", "_stg_load_ts", "_stg_file_name") if c in rows.columns]
    others = [c for c in rows.columns if c != key and c not in age]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in (*age, *others))
    ranked = rows.selectExpr(
        "*", f"row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _rank"
    )
    return ranked.filter("_rank = 1").drop("_rank")


def clean_rows(stage: DataFrame, entity: Entity) -> tuple[DataFrame, DataFrame]:
    """Typed, guarded, one row per key; and the rejected rows."""
    accepted, rejected = split_required(stage, entity)
    return last_per_key(accepted, entity.key), rejected
