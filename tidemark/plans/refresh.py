"""The layered job: land, clean, check, and, if the checks allow it, refresh the consumption layer.

All state is in tables below one root folder. Every step can be run again after a failure: it first puts in
place what a killed writer left beside its table, how far it has come is noted only after its table is written,
and applying a batch twice changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.entities import DIMENSIONS, ENTITIES, Dimension, Entity, dimension_schema
from tidemark.operators import consumption, governance, quality
from tidemark.operators.clean import loadable, reject_schema, type_rows
from tidemark.operators.joins import rows_with
from tidemark.operators.numbering import lanes_for, number_rows
from tidemark.operators.scd2 import scd2_step
from tidemark.operators.upsert import apply_dealt, backfill_dates, prepare_batch, require_none
from tidemark.plans import reports
from tidemark.sources.shared import dropped, scratch, side_by_side, written
from tidemark.sources.tables import BUCKETS, bucket_of, gathered, parts_of, read_table, replace_parts, settle
from tidemark.streaming import feed

BUCKET, MONTH = "_bucket", "_month"
#: Which refresh of the clean layer wrote a row last.
BATCH = T.StructField("_batch", T.LongType())
_MARK = T.StructType([T.StructField("seq", T.LongType()), T.StructField("note", T.StringType())])

_RELEASE = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("released_ts", T.TimestampNTZType()),
        T.StructField("fail_count", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class RefreshResult:
    status: str
    fail_count: int
    message: str
    batch_id: str


class LayeredJob:
    """Nine entities through three layers.

    ``landing`` holds one folder of text extracts per entity. ``gate_mode`` is ``batch`` (failures
    of this run block) or ``window`` (any failure of the last five minutes blocks). A table is kept in
    ``buckets`` partitions by a hash of its key, the fact in one per month of order date.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        landing: str,
        buckets: int = BUCKETS,
        gate_mode: str = "batch",
        distinct_key: bool = False,
        strict: bool = False,
        files_per_batch: int | None = None,
    ):
        if gate_mode not in ("batch", "window"):
            raise ValueError(f"unknown gate mode {gate_mode!r}")
        self.spark = spark
        self.root = root.rstrip("/")
        self.landing = landing.rstrip("/")
        self.buckets = buckets
        self.gate_mode = gate_mode
        self.distinct_key = distinct_key
        self.strict = strict
        self.files_per_batch = files_per_batch

    # Tables

    def stage(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.root}/stage/{name}", feed.stage_table_schema(ENTITIES[name]))

    def clean(self, name: str) -> DataFrame:
        return self._clean(name).select(*ENTITIES[name].clean_schema().fieldNames())

    def _clean(self, name: str, parts: Iterable[int] | None = None) -> DataFrame:
        schema = T.StructType([*ENTITIES[name].clean_schema().fields, BATCH])
        return read_table(self.spark, f"{self.root}/clean/{name}", schema, BUCKET, parts)

    def rejects(self, name: str) -> DataFrame:
        schema = T.StructType([*reject_schema(ENTITIES[name]).fields, T.StructField("batch", T.StringType())])
        return read_table(self.spark, f"{self.root}/rejects/{name}", schema)

    def _dimension(self, name: str, parts: Iterable[int] | None = None) -> DataFrame:
        schema = dimension_schema(DIMENSIONS[name])
        return read_table(self.spark, f"{self.root}/consumption/{name}", schema, BUCKET, parts)

    def dimension(self, name: str, current_only: bool = False) -> DataFrame:
        """All versions, or only the open ones."""
        versions = self._dimension(name).drop(BUCKET)
        return versions.filter("is_current") if current_only else versions

    def address_dim(self) -> DataFrame:
        return self._addresses().drop(BUCKET)

    def _addresses(self, parts: Iterable[int] | None = None) -> DataFrame:
        path = f"{self.root}/consumption/customer_address_dim"
        return read_table(self.spark, path, consumption.ADDRESS_DIM_SCHEMA, BUCKET, parts)

    def date_dim(self) -> DataFrame:
        path = f"{self.root}/consumption/date_dim"
        return read_table(self.spark, path, consumption.DATE_DIM_SCHEMA, BUCKET).drop(BUCKET)

    def _fact(self, months: Iterable[int] | None = None) -> DataFrame:
        path = f"{self.root}/consumption/order_item_fact"
        rows = read_table(self.spark, path, consumption.FACT_SCHEMA, MONTH, months)
        # A month that has lost all its rows is kept as one row without an item.
        return rows.filter("order_item_id IS NOT NULL")

    def fact(self) -> DataFrame:
        return self._fact().drop(MONTH)

    def fact_as_of(self) -> DataFrame:
        """The fact against the dimension versions that were valid when each order was placed."""
        clean = {n: self.clean(n) for n in ("orders", "delivery", "order_item")}
        dims = {n: self.dimension(n) for n in DIMENSIONS} | {"date_dim": self.date_dim()}
        return consumption.build_fact_as_of(clean, dims)

    def log(self) -> DataFrame:
        return read_table(self.spark, f"{self.root}/common/dq_log", quality.LOG_SCHEMA)

    def releases(self) -> DataFrame:
        """The refreshes that were let pass although the gate held them back, and with how many failed checks."""
        return read_table(self.spark, f"{self.root}/common/releases", _RELEASE)

    def view(self, name: str, role: str) -> DataFrame:
        """A clean table, its rejects (``<entity>_rejects``) or a dimension, as ``role`` may see it."""
        if name in DIMENSIONS:
            return governance.masked(self.dimension(name), role, DIMENSIONS[name])
        entity = name.removesuffix("_rejects")
        rows = self.clean(entity) if entity == name else self.rejects(entity)
        return governance.masked(rows, role, ENTITIES[entity])

    def create_views(self, role: str | None = None) -> None:
        """The reports as named views of this session, for SQL; with a ``role`` also the clean tables and the
        dimensions, as that role may see them (``clean_<entity>``, ``<entity>_dim``)."""
        agents, restaurants = (self.dimension(f"{n}_dim") for n in ("delivery_agent", "restaurant"))
        fact = self.fact()
        views = {
            "monthly_revenue": reports.monthly_revenue(fact, self.date_dim()),
            "revenue_by_cuisine": reports.revenue_by_cuisine(fact, restaurants),
            "delivery_performance": reports.delivery_performance(fact, agents),
            "latest_dq_status": quality.latest_status(self.log()),
        }
        if role is not None:
            views |= {f"clean_{name}": self.view(name, role) for name in ENTITIES}
            views |= {name: self.view(name, role) for name in DIMENSIONS}
        for name, frame in views.items():
            frame.createOrReplaceTempView(name)

    # How far each table has come

    def _marks(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.root}/common/marks/{name}", _MARK)

    def _mark(self, name: str) -> dict[str, Any]:
        """What the last finished refresh of a table had seen; empty before the first."""
        last = self._marks(name).orderBy(F.desc("seq")).first()
        return json.loads(last.note) if last else {}

    def _set_mark(self, name: str, seen: dict[str, Any]) -> None:
        seq = self._marks(name).agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0] + 1
        row = self.spark.createDataFrame([(seq, json.dumps(seen, sort_keys=True))], _MARK)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/common/marks/{name}")

    def _clean_state(self, name: str) -> tuple[int, int]:
        """The last batch of a clean table and its highest number.

        They are in its mark, unless a batch was cut off after it had begun: only then the table is read.
        """
        mark = self._mark(f"clean_{name}")
        if mark and not mark["open"]:
            return mark["batch"], mark["top"]
        zero = F.lit(0).cast("long")
        number = ENTITIES[name].surrogate
        return tuple(self._clean(name).agg(F.coalesce(F.max("_batch"), zero), F.coalesce(F.max(number), zero)).first())

    def _last_batch(self, name: str) -> int:
        return self._clean_state(name)[0]

    def _write_clean(
        self, entity: Entity, rows: DataFrame, batch: int, top: int, touched: list[int], left: Iterable[int] | None = ()
    ) -> None:
        """Store the touched buckets of a clean table as they are after a batch, between two marks.

        ``rows`` lie by bucket already. ``left``: the months that fact rows have to leave for it, None if that is not known.
        """
        mark = {"batch": batch, "top": top, "touched": touched, "left": None if left is None else list(left)}
        self._set_mark(f"clean_{entity.name}", mark | {"open": 1})
        replace_parts(rows, f"{self.root}/clean/{entity.name}", BUCKET)
        stored = self._clean(entity.name, touched).filter(F.col("_batch") == batch)
        highest = stored.agg(F.coalesce(F.max(entity.surrogate), F.lit(0).cast("long"))).first()[0]
        self._set_mark(f"clean_{entity.name}", mark | {"top": max(top, highest), "open": 0})

    # Stage to clean

    def refresh_clean(self, batch_ts: datetime | None = None) -> str:
        """Land new extracts and upsert what each change feed holds.

        The entities do not depend on each other here (references are checked afterwards), so their
        feeds run side by side.
        """
        side_by_side(
            self.spark, [partial(self._refresh_entity, e, batch_ts) for e in ENTITIES.values()]
        )
        return "clean layer refreshed"

    def _refresh_entity(self, entity: Entity, batch_ts: datetime | None) -> None:
        stage = f"{self.root}/stage/{entity.name}"
        marks = f"{self.root}/_checkpoints/{entity.name}"
        landing = f"{self.landing}/{entity.name}"
        feed.land(self.spark, entity, landing, stage, f"{marks}/land", self.files_per_batch)
        feed.drain(
            feed.changes(self.spark, feed.stage_table_schema(entity), stage, self.files_per_batch),
            f"{marks}/clean",
            lambda rows, tag: self.apply_batch(entity, rows, tag, batch_ts or utc_now()),
        )

    def apply_batch(self, entity: Entity, stage: DataFrame, tag: str, batch_ts: datetime) -> None:
        """Upsert one feed batch into the partitions its keys fall in.

        Applied again, say after a failure half-way, it finds its own rows and leaves the same table.
        """
        settle(self.spark, f"{self.root}/clean/{entity.name}")
        rows, rejects = prepare_batch(stage, entity, batch_ts)
        if self.strict:
            require_none(rejects, entity)
        number = tag.rsplit("#", 1)[-1]
        rejects.write.mode("overwrite").parquet(f"{self.root}/rejects/{entity.name}/batch={number}")
        counts = self._rows_by_bucket(entity, stage)
        touched = sorted(counts)
        if not touched:
            return
        batch, top = self._clean_state(entity.name)
        lanes = lanes_for(sum(counts.values()), self.buckets)
        marks = {"_batch": F.lit(batch + 1).cast("long"), BUCKET: bucket_of(entity.key, self.buckets)}
        if batch == 0:
            # Batches count from one, so nothing is stored yet: all rows are new.
            new = number_rows(rows.withColumns(marks), entity.key, entity.surrogate, top, lanes, BUCKET)
            names = self._clean(entity.name).columns
            self._write_clean(entity, new.select(*names), 1, top, touched)
            return
        path = scratch(self.spark, f"batch-{entity.name}")
        rows = written(rows, path).withColumns(marks)
        target = self._clean(entity.name, touched)
        merged = apply_dealt(target, rows, entity, top, BUCKET, lanes, extra=("_batch",))
        self._write_clean(entity, merged, batch + 1, top, touched, self._left(entity, target, rows))
        dropped(self.spark, path)

    def _rows_by_bucket(self, entity: Entity, stage: DataFrame) -> dict[int, int]:
        """How many rows of a batch can be loaded, by the bucket of their key; a key sent twice counts twice."""
        rows = type_rows(stage.filter(loadable(stage, entity)), entity)
        buckets = rows.groupBy(bucket_of(entity.key, self.buckets).alias(BUCKET))
        return {r[0]: r[1] for r in buckets.agg(F.count("*")).collect()}

    def _left(self, entity: Entity, stored: DataFrame, rows: DataFrame) -> list[int] | None:
        """The months in which fact rows are that a batch moves to another one; None if it does not show.

        An order takes its items along from the month of its stored date. An item that changes its order
        comes from a month that only the fact knows.
        """
        column = {"orders": "order_date", "order_item": "order_id"}.get(entity.name)
        if column is None:
            return []
        new = rows.select(entity.key, F.col(column).alias("_new"))
        pairs = stored.select(entity.key, column).join(new, entity.key)
        if entity.name == "order_item":
            return [] if pairs.filter(f"{column} <> _new").isEmpty() else None
        month = "CAST(date_format({}, 'yyyyMM') AS int)".format
        moved = pairs.selectExpr(f"{month(column)} AS was", f"{month('_new')} AS will")
        return parts_of(moved.filter("was IS NOT NULL AND NOT was <=> will"), "was")

    def repair_dates(self, name: str, pattern: str | None) -> None:
        """Re-derive a clean table's audit dates from all its stage rows, read with ``pattern``.

        The upsert never changes a creation date, so one that was read wrongly stays until this. The
        rows count as written anew.
        """
        entity = ENTITIES[name]
        settle(self.spark, f"{self.root}/clean/{name}")
        batch, top = self._clean_state(name)
        table = self._clean(name).drop(BUCKET).withColumn("_batch", F.lit(batch + 1).cast("long"))
        repaired = backfill_dates(table, self.stage(name), entity, pattern)
        repaired = gathered(repaired.withColumn(BUCKET, bucket_of(entity.key, self.buckets)), BUCKET)
        self._write_clean(entity, repaired, batch + 1, top, list(range(self.buckets)))

    # Checks

    def refresh_checks(self, batch_id: str, batch_ts: datetime | None = None) -> str:
        """Append one log row per entity; the checks read the whole stage and clean tables."""
        last = self.log().agg(F.coalesce(F.max("run_id"), F.lit(0).cast("bigint"))).first()[0]
        rows = quality.run_checks(
            {n: self.stage(n) for n in ENTITIES},
            {n: self.clean(n) for n in ENTITIES},
            batch_id,
            batch_ts or utc_now(),
            last,
            distinct_key=self.distinct_key,
        )
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/common/dq_log")
        return "checks logged"

    def gate(self, batch_id: str, now: datetime | None = None) -> RefreshResult:
        if self.gate_mode == "batch":
            row = quality.gate(self.log(), batch_id=batch_id).first()
        else:
            row = quality.gate(
                self.log(), now=now or utc_now(), window=timedelta(minutes=5)
            ).first()
        return RefreshResult(row.status, row.fail_count, row.message, batch_id)

    # Clean to consumption

    def refresh_consumption(
        self, batch_id: str, batch_ts: datetime | None = None, release: bool = False
    ) -> RefreshResult:
        """Dimensions, calendar and fact, unless the gate says no: then nothing is touched.

        ``release`` lets a held-back refresh pass, by someone's decision; ``releases`` then has a row of it.
        """
        batch_ts = batch_ts or utc_now()
        verdict = self.gate(batch_id, batch_ts)
        if verdict.status != "OK" and not release:
            return verdict
        if verdict.status != "OK":
            row = self.spark.createDataFrame([(batch_id, batch_ts, verdict.fail_count, verdict.message)], _RELEASE)
            row.coalesce(1).write.mode("append").parquet(f"{self.root}/common/releases")
        for name in (*DIMENSIONS, "customer_address_dim", "date_dim", "order_item_fact"):
            settle(self.spark, f"{self.root}/consumption/{name}")
        dimensions = [partial(self._refresh_dimension, d, batch_ts) for d in DIMENSIONS.values()]
        side_by_side(
            self.spark, [*dimensions, self._refresh_address_dim, self._refresh_calendar]
        )
        self._refresh_fact()
        message = "consumption layer refreshed" if verdict.status == "OK" else "refresh released"
        return RefreshResult("OK", verdict.fail_count, message, batch_id)

    def _changed(self, entity: str, since: int) -> DataFrame:
        """The clean rows written since a batch, from the buckets that the batches since then have touched."""
        notes = self._notes(entity, since)
        parts = None if notes is None else sorted({b for note in notes for b in note["touched"]})
        return self._clean(entity, parts).filter(F.col("_batch") > since)

    def _notes(self, entity: str, since: int) -> list[dict[str, Any]] | None:
        """The marks of the batches since a batch, also of those that were cut off; None for a table without marks."""
        notes = [json.loads(r.note) for r in self._marks(f"clean_{entity}").collect()]
        return [note for note in notes if note["batch"] > since] if notes else None

    def _refresh_dimension(self, dim: Dimension, batch_ts: datetime) -> None:
        entity = ENTITIES[dim.entity]
        seen = self._mark(dim.name)
        since, top = seen.get("batch", 0), seen.get("top", 0)
        now, numbers = self._clean_state(entity.name)
        if now <= since:
            return
        changed = self._changed(entity.name, since)
        touched = parts_of(changed, BUCKET)
        versions = self._dimension(dim.name, touched).drop(BUCKET)
        step = scd2_step(versions.filter("is_current"), changed, dim, batch_ts, top)
        # A bucket holds the open and the closed versions of its keys, so both change together.
        rows = versions.filter("NOT is_current").unionByName(step)
        rows = rows.withColumn(BUCKET, bucket_of(entity.key, self.buckets))
        replace_parts(gathered(rows, BUCKET), f"{self.root}/consumption/{dim.name}", BUCKET)
        # A version's number is its clean row's above ``top``, so none is beyond this.
        self._set_mark(dim.name, {"batch": now, "top": top + numbers})

    def _refresh_address_dim(self) -> None:
        name, entity = "customer_address_dim", ENTITIES["customer_address"]
        since, now = self._mark(name).get("batch", 0), self._last_batch(entity.name)
        if now <= since:
            return
        changed = self._changed(entity.name, since)
        merged = consumption.address_dim(self._addresses(parts_of(changed, BUCKET)).drop(BUCKET), changed)
        rows = merged.withColumn(BUCKET, bucket_of(entity.key, self.buckets))
        replace_parts(gathered(rows, BUCKET), f"{self.root}/consumption/{name}", BUCKET)
        self._set_mark(name, {"batch": now})

    def _refresh_calendar(self) -> None:
        name = "date_dim"
        since, now = self._mark(name).get("batch", 0), self._last_batch("orders")
        if now > since:
            days = consumption.date_dim(self.clean("orders")).withColumn(BUCKET, F.lit(0))
            replace_parts(days.coalesce(1), f"{self.root}/consumption/{name}", BUCKET)
            self._set_mark(name, {"batch": now})

    def _refresh_fact(self) -> None:
        """Re-join the items that anything relevant happened to since the last refresh."""
        name = "order_item_fact"
        since = self._mark(name)
        waiting = set(since.pop("left", ()))
        now = {n: self._last_batch(n) for n in ("orders", "delivery", "order_item")}
        now |= {n: self._mark(n).get("top", 0) for n in DIMENSIONS}
        if since == now:
            return
        clean = {n: self.clean(n) for n in ("orders", "delivery", "order_item")}
        dims = {n: self.dimension(n, current_only=True) for n in DIMENSIONS}
        dims["date_dim"] = self.date_dim()
        path = f"{self.root}/consumption/{name}"
        if since:
            path_of_items = scratch(self.spark, "changed-items")
            items = written(self._items_since(since, clean, dims), path_of_items)
            clean["order_item"] = items
            for n in ("orders", "delivery"):
                wanted = rows_with(clean[n], items, "order_id")
                clean[n] = clean[n].limit(0) if wanted is None else wanted
            waiting = self._replace_facts(path, items, consumption.build_fact(clean, dims), since, waiting)
            dropped(self.spark, path_of_items)
        else:
            replace_parts(gathered(with_month(consumption.build_fact(clean, dims)), MONTH), path, MONTH)
        self._set_mark(name, now | {"left": sorted(waiting)})

    def _items_since(
        self, since: dict[str, int], clean: dict[str, DataFrame], dims: dict[str, DataFrame]
    ) -> DataFrame:
        changed = {n: self._changed(n, since[n]).select(*frame.columns) for n, frame in clean.items()}
        renewed = {n: dims[n].filter(F.col(d.surrogate) > since[n]) for n, d in DIMENSIONS.items()}
        orders = consumption.orders_to_refresh(clean, changed, renewed, dims["restaurant_dim"])
        items = self._clean("order_item").withColumn("_written", F.col("_batch") > since["order_item"])
        return consumption.items_to_refresh(items, changed["order_item"], orders, renewed["menu_dim"])

    def _replace_facts(
        self, path: str, items: DataFrame, rows: DataFrame, since: dict[str, int], waiting: set[int]
    ) -> set[int]:
        """Merge new fact rows into the months they fall in and the months they were in.

        The latter are in the marks of the clean tables; only for items that changed their order the fact is
        searched. An item without a fact row at present stays where it was, so the months left this time are
        returned as ``waiting``, and count again when it has one. A refresh that failed half-way can have left
        an item in both months; it is reduced to one row first.
        """
        path_of_rows = scratch(self.spark, "changed-facts")
        rows = written(with_month(rows), path_of_rows)
        noted = []
        for name in ("orders", "order_item"):
            notes = self._notes(name, since[name])
            noted += [None] if notes is None else [note.get("left") for note in notes]
        left = {month for months in noted if months for month in months}
        if None in noted:
            stored = rows_with(self._fact(), items, "order_item_id")
            left |= set(parts_of(stored, MONTH)) if stored is not None else set()
        months = set(parts_of(rows, MONTH)) | left | waiting
        if left and not items.join(rows, "order_item_id", "left_anti").isEmpty():
            waiting = waiting | left
        if not months:
            return waiting
        merged = with_month(consumption.upsert_fact(self._fact(months).drop(MONTH), rows.drop(MONTH), stored=True))
        nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in consumption.FACT_SCHEMA)
        kept = self.spark.sql(
            f"SELECT {nothing}, m AS {MONTH} FROM (SELECT explode(array({', '.join(map(str, sorted(months)))})) AS m)"
        )
        replace_parts(gathered(merged.unionByName(kept), MONTH), path, MONTH)
        dropped(self.spark, path_of_rows)
        return waiting

    # The chain

    def run(self, batch_ts: datetime | None = None, batch_id: str | None = None) -> RefreshResult:
        batch_id = batch_id or uuid.uuid4().hex
        self.refresh_clean(batch_ts)
        self.refresh_checks(batch_id, batch_ts)
        return self.refresh_consumption(batch_id, batch_ts)


def with_month(fact: DataFrame) -> DataFrame:
    """Fact rows with the month of their order date, as yyyymm."""
    return fact.withColumn(MONTH, F.expr("date_dim_sk DIV 100").cast("int"))
