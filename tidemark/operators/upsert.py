"""Keyed upsert, straight table-to-table upsert, and keyed backfill."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.entities import Entity
from tidemark.functions.typing_rules import moment
from tidemark.operators.clean import clean_rows
from tidemark.operators.joins import not_broadcast
from tidemark.operators.numbering import LANES, highest, lane_of, number_rows


class RequiredValueMissing(ValueError):
    """A batch holds rows without a required value and the caller asked for all or nothing."""


def merge(target: DataFrame, source: DataFrame, key: str, overwrite: Sequence[str]) -> DataFrame:
    """Full outer merge by ``key``; both sides hold a key at most once.

    Key on both sides: the ``overwrite`` columns come from the source, also when they are NULL there,
    the others stay. Key in the source only: the source row. Key in the target only: untouched.
    """
    left = target.selectExpr("*", "true AS _in_target")
    right = source.selectExpr(
        key, "true AS _in_source", *[f"{c} AS _new_{c}" for c in target.columns if c != key]
    )

    def pick(name: str) -> str:
        if name == key:
            return key
        test = "_in_source IS NOT NULL" if name in overwrite else "_in_target IS NULL"
        return f"CASE WHEN {test} THEN _new_{name} ELSE {name} END AS {name}"

    merged = left.join(right, key, "full_outer").selectExpr(*[pick(c) for c in target.columns])
    # Expressions drop the column tags.
    return merged.to(optional(target.schema))


def optional(schema: T.StructType) -> T.StructType:
    """The schema with its tags, every column nullable."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def numbered_new(
    rows: DataFrame, target: DataFrame, key: str, name: str, base: Column | int, lanes: int = LANES
) -> DataFrame:
    """``rows`` with a number above ``base`` for each key that the target lacks; NULL for the others.

    Only new keys are numbered, and as a narrow frame: a batch of updates moves none of its rows for it. Neither they
    nor the target's keys are broadcast.
    """
    new = rows.select(key).join(not_broadcast(target.select(key)), key, "left_anti")
    return rows.join(not_broadcast(number_rows(new, key, name, base, lanes)), key, "left")


def prepare_batch(stage: DataFrame, entity: Entity, batch_ts: datetime) -> tuple[DataFrame, DataFrame]:
    """A stage batch as typed rows, one per key, copied at the batch time; and its rejects."""
    rows, rejects = clean_rows(stage, entity)
    names = [c for c in rows.columns if c != "_copy_ts"]
    return rows.selectExpr(*names, f"{moment(batch_ts)} AS _copy_ts"), rejects


def apply_rows(
    target: DataFrame,
    rows: DataFrame,
    entity: Entity,
    base: Column | int,
    extra: Sequence[str] = (),
    lanes: int = LANES,
    first: bool = False,
) -> DataFrame:
    """The target after a prepared batch; ``extra`` columns, if any, are overwritten as well.

    ``first``: the target is known to hold no row and ``rows`` are read from files, so all of them are numbered
    where they are, in one shuffle, and no key is looked up.
    """
    if first:
        rows = number_rows(rows, entity.key, entity.surrogate, base, lanes)
    else:
        rows = numbered_new(rows, target, entity.key, entity.surrogate, base, lanes)
    return merge(target, rows, entity.key, (*entity.overwritten, *extra))


def _paired(target: DataFrame, source: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Target and source rows side by side (``_key``, ``_stored``, ``_new``), shuffled once, by ``by`` or else the key.

    The source holds a key at most once. Of target rows of one key, which must not matter, one is taken. Keys are not
    NULL. Both sides are one frame, so that neither is sorted ahead of the shuffle, and a task's rows are in order.
    """
    names = [c for c in target.columns if c not in by]
    given = [c for c in names if c in source.columns]

    def none(columns: Sequence[str]) -> str:
        return f"CAST(NULL AS struct<{', '.join(f'{c}: {target.schema[c].dataType.simpleString()}' for c in columns)}>)"

    def side(frame: DataFrame, stored: str, new: str) -> DataFrame:
        return frame.selectExpr(*by, f"{key} AS _key", f"{stored} AS _stored", f"{new} AS _new")

    both = side(target, f"struct({', '.join(names)})", none(given))
    both = both.unionAll(side(source, none(names), f"struct({', '.join(given)})")).repartition(*(by or ["_key"]))
    return both.groupBy(*by, "_key").agg(F.first("_stored", True).alias("_stored"), F.first("_new", True).alias("_new"))


def _picked(name: str, overwrite: bool) -> str:
    test = "_new IS NOT NULL" if overwrite else "_stored IS NULL"
    return f"CASE WHEN {test} THEN _new.{name} ELSE _stored.{name} END AS {name}"


def merge_stored(target: DataFrame, source: DataFrame, key: str, overwrite: Sequence[str]) -> DataFrame:
    """What ``merge`` gives, for a target in which a key may be twice, of which one row stays."""
    columns = [f"_key AS {key}" if c == key else _picked(c, c in overwrite) for c in target.columns]
    return _paired(target, source, key, []).selectExpr(*columns).to(optional(target.schema))


def apply_dealt(
    target: DataFrame,
    rows: DataFrame,
    entity: Entity,
    base: int,
    part: str,
    lanes: int,
    extra: Sequence[str] = (),
) -> DataFrame:
    """What ``apply_rows`` gives, for a stored table: both sides are shuffled once, into lanes, and stay there.

    Target and rows hold ``part``, which follows from the key and of which a lane has one value. Lanes bring the two
    rows of a key together and number the new ones, and the result can be written by ``part`` as it lies.
    """
    key, number = entity.key, entity.surrogate
    lane = F.expr(lane_of(key, lanes))
    paired = _paired(target.withColumn("_lane", lane), rows.withColumn("_lane", lane), key, [part, "_lane"])
    place = f"count_if(_stored IS NULL) OVER (PARTITION BY {part}, _lane ORDER BY _key ROWS UNBOUNDED PRECEDING)"
    new = f"{base}L + (_place - 1L) * {lanes}L + _lane + 1L"
    own = {part: part, key: f"_key AS {key}", number: f"CASE WHEN _stored IS NULL THEN {new} ELSE _stored.{number} END AS {number}"}
    overwrite = {*entity.overwritten, *extra}
    columns = [own.get(c) or _picked(c, c in overwrite) for c in target.columns]
    # Expressions drop the column tags.
    return paired.selectExpr("*", f"{place} AS _place").selectExpr(*columns).to(optional(target.schema))


def upsert(
    target: DataFrame,
    stage: DataFrame,
    entity: Entity,
    batch_ts: datetime,
    strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Apply one stage batch to the clean table; returns the new table and the rejected rows."""
    rows, rejects = prepare_batch(stage, entity, batch_ts)
    if strict:
        require_none(rejects, entity)
    return apply_rows(target, rows, entity, highest(target, entity.surrogate)), rejects


def require_none(rejects: DataFrame, entity: Entity) -> None:
    if not rejects.isEmpty():
        raise RequiredValueMissing(f"{entity.name}: rows without a required value in the batch")


def backfill_dates(
    table: DataFrame, stage: DataFrame, entity: Entity, pattern: str | None
) -> DataFrame:
    """Re-derive the audit dates of matched keys from stage text, overwriting even with NULL.

    A key sent several times takes both dates of the one row that an upsert would choose.
    """
    dates = ("created_dt", "modified_dt")
    columns = tuple(replace(c, pattern=pattern) if c.name in dates else c for c in entity.columns)
    winner, _ = clean_rows(stage, replace(entity, columns=columns))
    fresh = winner.selectExpr(entity.key, "true AS _hit", *[f"{c} AS _new_{c}" for c in dates])
    picked = [
        f"CASE WHEN _hit THEN _new_{c} ELSE {c} END AS {c}" if c in dates else c for c in table.columns
    ]
    return table.join(fresh, entity.key, "left").selectExpr(*picked).to(optional(table.schema))
