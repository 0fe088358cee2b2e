"""Checks of a load from stage to clean, the gate over their log, and the latest status."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.entities import ENTITIES, Entity
from tidemark.functions.typing_rules import as_key
from tidemark.operators.clean import loadable

TRANSITION = "stage_to_clean"

LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("layer_transition", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("null_check_status", T.StringType()),
        T.StructField("fk_check_status", T.StringType()),
        T.StructField("fk_check_detail", T.StringType()),
        T.StructField("overall_status", T.StringType()),
        T.StructField("run_ts", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
    ]
)


def _marks(rows: DataFrame, checks: list[str]) -> DataFrame:
    """The marks of all rows: (check, ref, slot, n), of which those without a check are left out."""
    # Left out afterwards: a filter of the array is not compiled.
    return rows.selectExpr(f"inline(array({', '.join(checks)}))").filter("check IS NOT NULL")


def _mark(check: int, ref: str, slot: int, when: str = "true") -> str:
    return (
        f"struct(CASE WHEN {when} THEN {check} END AS check, CAST({ref} AS bigint) AS ref,"
        f" {slot} AS slot, 1L AS n)"
    )


_PARENT = 2  # the slot of a row that others may refer to; 0 and 1 are those of the references


def _references(entities: Sequence[Entity]) -> dict[tuple[str, str], int]:
    """The slot of each reference (child, column) among those to its parent."""
    slots: dict[tuple[str, str], int] = {}
    taken: dict[str, int] = {}
    for entity in entities:
        for fk in entity.foreign_keys:
            slots[entity.name, fk.column] = taken.get(fk.parent, 0)
            taken[fk.parent] = slots[entity.name, fk.column] + 1
    if max(taken.values(), default=0) > _PARENT:
        raise ValueError("a table is referred to from more than two columns")
    return slots


class _Codes(dict):
    """The number of each check by its name: marks of a fixed width are counted in place and cross the shuffle shorter."""

    def __missing__(self, check: str) -> int:
        self[check] = len(self)
        return self[check]


def _stage_marks(stage: DataFrame, clean: DataFrame, entity: Entity, distinct_key: bool, codes: _Codes) -> DataFrame:
    """What a stage table adds: its rows, or its keys and faulty rows, and the texts of suspect keys."""
    key = as_key(entity.column(entity.key).stage)
    name = entity.name
    if distinct_key:
        marks = [
            _mark(codes[f"in {name}"], "NULL", 0, "NOT _loadable"),
            _mark(codes[f"key {name}"], key, 0, "_loadable"),
        ]
        rows = stage.withColumn("_loadable", F.expr(loadable(stage, entity)))
    else:
        marks = [_mark(codes[f"in {name}"], "NULL", 0)]
        rows = stage
    for column in entity.lost_value_columns:
        # Only keys between those of clean rows without the value can have lost one.
        bounds = clean.filter(f"{column} IS NULL").selectExpr(
            f"struct(min({entity.key}) AS low, max({entity.key}) AS high)"
        )
        rows = rows.withColumn(f"_near_{column}", bounds.scalar())
        near = f"{key} BETWEEN _near_{column}.low AND _near_{column}.high"
        full = f"{entity.column(column).stage} IS NOT NULL"
        marks.append(_mark(codes[f"lost {name} {column}"], key, 0, f"{full} AND {near}"))
    return _marks(rows, marks)


def _clean_marks(
    clean: DataFrame, entity: Entity, slots: dict[tuple[str, str], int], codes: _Codes, parents: set[str] | None = None
) -> DataFrame:
    """What a clean table adds: its rows, its keys if it is one of ``parents``, its references, and the keys that miss a value."""
    marks = [_mark(codes[f"out {entity.name}"], "NULL", 0)]
    if parents is None or entity.name in parents:
        marks.append(_mark(codes[f"ref {entity.name}"], entity.key, _PARENT))
    for fk in entity.foreign_keys:
        counts = "true" if fk.null_is_orphan else f"{fk.column} IS NOT NULL"
        marks.append(_mark(codes[f"ref {fk.parent}"], fk.column, slots[entity.name, fk.column], counts))
    for column in entity.lost_value_columns:
        marks.append(_mark(codes[f"lost {entity.name} {column}"], entity.key, _PARENT, f"{column} IS NULL"))
    return _marks(clean, marks)


def run_checks(
    stage: dict[str, DataFrame],
    clean: dict[str, DataFrame],
    batch_id: str,
    batch_ts: datetime,
    last_run_id: Column | int = 0,
    entities: Sequence[Entity] = tuple(ENTITIES.values()),
    distinct_key: bool = False,
) -> DataFrame:
    """One log row per entity, in one job that passes each table once.

    A row leaves a few marks: that it is there, its key, what it refers to, whether it misses a value.
    Marks are counted by check and referenced key, which combines inside each task, so a key that many
    rows share crosses the shuffle as one row per task. An orphan is a reference whose key left no
    mark of its own; a lost value is a text in stage whose key is marked as missing the value in clean.

    ``distinct_key``: rows in are the different keys that can be loaded, so a re-sent key counts once,
    plus every row that cannot be loaded.
    """
    slots, codes = _references(entities), _Codes()
    parents = {fk.parent for entity in entities for fk in entity.foreign_keys}
    frames = []
    for entity in entities:
        frames.append(_stage_marks(stage[entity.name], clean[entity.name], entity, distinct_key, codes))
        frames.append(_clean_marks(clean[entity.name], entity, slots, codes, parents))
    by_ref = reduce(DataFrame.unionAll, frames).groupBy("check", "ref").agg(
        *[F.sum(F.when(F.col("slot") == i, F.col("n"))).alias(f"n{i}") for i in range(_PARENT + 1)]
    )
    totals = by_ref.groupBy("check").agg(
        F.sum("n0").alias("rows"),
        F.count("*").alias("refs"),
        F.sum(F.when(F.col("n2").isNotNull(), F.col("n0"))).alias("hits"),
        *[F.sum(F.when(F.col("n2").isNull(), F.col(f"n{i}"))).alias(f"orphans{i}") for i in range(_PARENT)],
    )
    labels = []

    def label(entity: Entity, kind: str, column: str, check: str, value: str) -> None:
        position = entities.index(entity) + 1
        labels.append(f"({len(labels)}, '{entity.name}', {position}, '{kind}', '{column}', {codes[check]}, '{value}')")

    for entity in entities:
        label(entity, "in", "", f"in {entity.name}", "rows")
        if distinct_key:
            label(entity, "in", "", f"key {entity.name}", "refs")
        label(entity, "out", "", f"out {entity.name}", "rows")
        for column in entity.lost_value_columns:
            label(entity, "lost", column, f"lost {entity.name} {column}", "hits")
        for fk in entity.foreign_keys:
            label(entity, "fk", fk.column, f"ref {fk.parent}", f"orphans{slots[entity.name, fk.column]}")
    names = "number, table_name, position, kind, column, check, value"
    spark = stage[entities[0].name].sparkSession
    known = spark.sql(f"SELECT * FROM VALUES {', '.join(labels)} AS t({names})")
    values = ", ".join(f"'{v}', {v}" for v in ("rows", "refs", "hits", "orphans0", "orphans1"))
    counts = known.join(totals, "check", "left").selectExpr(
        "number AS check", "table_name", "position", "kind", "column", f"coalesce(map({values})[value], 0L) AS n"
    )
    return _log_rows(counts, batch_id, batch_ts, last_run_id)


def _log_rows(
    counts: DataFrame, batch_id: str, batch_ts: datetime, last_run_id: Column | int
) -> DataFrame:
    references = (
        "array_sort(collect_list(CASE WHEN kind = 'fk' THEN struct(check, column, n) END))"
    )
    one_reference = (
        "concat(f.column, ':', CASE WHEN f.n = 0 THEN 'PASS' ELSE concat('FAIL(', f.n, ')') END)"
    )
    folded = counts.groupBy("table_name", "position").agg(
        F.expr("sum(CASE WHEN kind = 'in' THEN n ELSE 0 END) AS rows_in"),
        F.expr("sum(CASE WHEN kind = 'out' THEN n ELSE 0 END) AS rows_out"),
        F.expr("sum(CASE WHEN kind = 'lost' THEN n ELSE 0 END) AS lost"),
        F.expr("sum(CASE WHEN kind = 'fk' THEN n ELSE 0 END) AS orphans"),
        F.expr(f"{references} AS refs"),
    )
    base = F.lit(last_run_id) if isinstance(last_run_id, int) else last_run_id
    return (
        folded.withColumn("run_id", (base + F.col("position")).cast("bigint"))
        .selectExpr(
            "run_id",
            f"'{TRANSITION}' AS layer_transition",
            "table_name",
            "rows_in",
            "rows_out",
            "CASE WHEN lost = 0 THEN 'PASS' ELSE 'FAIL' END AS null_check_status",
            "CASE WHEN size(refs) = 0 THEN 'N/A' WHEN orphans = 0 THEN 'PASS' ELSE 'FAIL' END"
            " AS fk_check_status",
            f"CASE WHEN size(refs) > 0 THEN concat_ws(';', transform(refs, f -> {one_reference})) END"
            " AS fk_check_detail",
            "CASE WHEN rows_in = rows_out AND lost = 0 AND orphans = 0 THEN 'PASS' ELSE 'FAIL' END"
            " AS overall_status",
            f"CAST('{batch_ts.isoformat(sep=' ')}' AS timestamp) AS run_ts",
            f"'{batch_id}' AS batch_id",
        )
    )


def gate(
    log: DataFrame,
    now: datetime | None = None,
    batch_id: str | None = None,
    window: timedelta = timedelta(minutes=5),
    expected: int = len(ENTITIES),
) -> DataFrame:
    """One row (status, fail_count, message): may the next layer run?

    With ``batch_id`` the failures of that batch block, and so does a batch of which not all
    ``expected`` tables were checked; otherwise any failure of the last ``window``, its first instant
    included.
    """
    if batch_id is not None:
        rows, least = log.filter(F.col("batch_id") == batch_id), expected
    else:
        since = (now - window).isoformat(sep=" ")
        rows, least = log.filter(f"run_ts >= CAST('{since}' AS timestamp)"), 0
    return rows.selectExpr(
        "count_if(overall_status = 'FAIL') AS fail_count", "count(DISTINCT table_name) AS checked"
    ).selectExpr(
        f"CASE WHEN fail_count > 0 OR checked < {least} THEN 'SKIPPED' ELSE 'OK' END AS status",
        "fail_count",
        "CASE WHEN fail_count > 0"
        " THEN concat('refresh held back: ', fail_count, ' failed check(s)')"
        f" WHEN checked < {least} THEN concat('refresh held back: ', checked, ' of {least} tables checked')"
        " ELSE 'refresh may run' END AS message",
    )


def latest_status(log: DataFrame) -> DataFrame:
    """The newest log row of each table."""
    ranked = log.selectExpr(
        "*", "row_number() OVER (PARTITION BY table_name ORDER BY run_id DESC) AS _rank"
    )
    return (
        ranked.filter("_rank = 1")
        .select(
            "table_name",
            "rows_in",
            "rows_out",
            "null_check_status",
            "fk_check_status",
            "overall_status",
            "run_ts",
        )
        .orderBy("table_name")
    )
