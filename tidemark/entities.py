"""The nine business entities, declared once.

Everything entity specific (column types, keys, what an upsert may overwrite, foreign keys, tags,
dimension tracking) lives here, so the operators stay generic and an entity is a config entry.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PLAIN = object()
"""Comparison mode of a tracked column: ordinary inequality, NULL on either side means unchanged."""


@dataclass(frozen=True)
class Column:
    """One typed column and the text column it is read from."""

    name: str
    kind: str
    stage: str
    required: bool = False
    pii: str | None = None
    precision: int = 0
    scale: int = 0
    yes: str = ""
    fold_case: bool = False
    pattern: str | None = None

    @property
    def data_type(self) -> T.DataType:
        if self.kind == "decimal":
            return T.DecimalType(self.precision, self.scale)
        return {
            "text": T.StringType(),
            "key": T.LongType(),
            "flag": T.BooleanType(),
            "date": T.DateType(),
            "timestamp": T.TimestampNTZType(),
        }[self.kind]


    @property
    def field(self) -> T.StructField:
        return T.StructField(self.name, self.data_type, metadata={"pii": self.pii} if self.pii else None)


@dataclass(frozen=True)
class ForeignKey:
    """A reference to another entity's business key."""

    column: str
    parent: str
    null_is_orphan: bool = False


@dataclass(frozen=True)
class Entity:
    name: str
    columns: tuple[Column, ...]
    insert_only: tuple[str, ...] = ("created_dt",)
    foreign_keys: tuple[ForeignKey, ...] = ()
    lost_value_columns: tuple[str, ...] = ("created_dt",)

    @property
    def key(self) -> str:
        return self.columns[0].name

    @property
    def surrogate(self) -> str:
        return f"{self.name}_sk"

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns if c.required)

    @property
    def overwritten(self) -> tuple[str, ...]:
        """Columns an upsert replaces when the key is already there."""
        return tuple(c.name for c in self.columns[1:] if c.name not in self.insert_only)

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    def stage_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.stage, T.StringType()) for c in self.columns])

    def clean_schema(self) -> T.StructType:
        fields = [T.StructField(self.surrogate, T.LongType()), *[c.field for c in self.columns]]
        return T.StructType([*fields, *AUDIT_SCHEMA.fields])

    @property
    def tags(self) -> dict[str, str]:
        """Columns that must carry a tag, with it."""
        return {c.name: c.pii for c in self.columns if c.pii}


AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("_stg_file_name", T.StringType()),
        T.StructField("_stg_load_ts", T.TimestampNTZType()),
        T.StructField("_copy_ts", T.TimestampNTZType()),
    ]
)


@dataclass(frozen=True)
class Dimension:
    """A type-2 dimension over one entity.

    ``tracked`` maps a column to ``PLAIN`` or to the literal that stands in for NULL on both sides.
    """

    name: str
    entity: str
    carried: tuple[str, ...]
    tracked: tuple[tuple[str, object], ...]

    @property
    def surrogate(self) -> str:
        return f"{self.name}_sk"

    @property
    def tags(self) -> dict[str, str]:
        return {c: t for c, t in ENTITIES[self.entity].tags.items() if c in self.carried}


def _key(name, required=False):
    return Column(name, "key", name, required=required)


def _text(name, required=False, pii=None):
    return Column(name, "text", name, required=required, pii=pii)


def _decimal(name, precision, scale):
    return Column(name, "decimal", name, precision=precision, scale=scale)


def _flag(name, yes="Y", fold_case=False):
    return Column(name, "flag", name, yes=yes, fold_case=fold_case)


def _audit_dates(pattern=None):
    return (
        Column("created_dt", "timestamp", "created_date", pattern=pattern),
        Column("modified_dt", "timestamp", "modified_date", pattern=pattern),
    )


DAY_FIRST = "dd-MM-yyyy HH:mm"

# Names, types, key order and tags have to equal the extracts this job reads.
ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity(
            "location",
            (
                _key("location_id", required=True),
                _text("city", required=True),
                _text("state", required=True),
                _text("zipcode"),
                _flag("active_flag"),
                *_audit_dates(),
            ),
            lost_value_columns=("zipcode",),
        ),
        Entity(
            "customer",
            (
                _key("customer_id", required=True),
                _text("name", required=True),
                _text("mobile", pii="PII"),
                _text("email", pii="EMAIL"),
                _text("gender", pii="PII"),
                Column("dob", "date", "dob", pii="PII"),
                *_audit_dates(),
            ),
        ),
        Entity(
            "restaurant",
            (
                _key("restaurant_id", required=True),
                _text("name", required=True),
                _text("cuisine_type"),
                _decimal("pricing_for_two", 10, 2),
                _text("restaurant_phone", pii="PII"),
                _text("operating_hours"),
                _key("location_id"),
                _flag("active_flag"),
                _text("open_status"),
                *_audit_dates(DAY_FIRST),
            ),
            foreign_keys=(ForeignKey("location_id", "location"),),
        ),
        Entity(
            "menu",
            (
                _key("menu_id", required=True),
                _key("restaurant_id", required=True),
                _text("item_name", required=True),
                _text("description"),
                _decimal("price", 10, 2),
                _text("category"),
                _flag("availability", yes="true", fold_case=True),
                _text("item_type"),
                *_audit_dates(),
            ),
            foreign_keys=(ForeignKey("restaurant_id", "restaurant"),),
        ),
        Entity(
            "delivery_agent",
            (
                _key("delivery_agent_id", required=True),
                _text("name", required=True),
                _text("phone", pii="PII"),
                _text("vehicle_type"),
                _key("location_id"),
                _text("status"),
                _text("gender", pii="PII"),
                _decimal("rating", 4, 2),
                *_audit_dates(),
            ),
            foreign_keys=(ForeignKey("location_id", "location"),),
        ),
        Entity(
            "customer_address",
            (
                _key("address_id", required=True),
                _key("customer_id", required=True),
                _text("flat_no"),
                _text("house_no"),
                _text("floor"),
                _text("building"),
                _text("landmark"),
                _text("locality"),
                _text("city"),
                _text("state"),
                _text("pincode"),
                _text("coordinates"),
                _flag("primary_flag"),
                _text("address_type"),
                *_audit_dates(),
            ),
            foreign_keys=(ForeignKey("customer_id", "customer"),),
        ),
        Entity(
            "orders",
            (
                _key("order_id", required=True),
                _key("customer_id", required=True),
                _key("restaurant_id", required=True),
                Column("order_date", "timestamp", "order_date"),
                _decimal("total_amount", 10, 2),
                _text("status"),
                _text("payment_method"),
                *_audit_dates(),
            ),
            foreign_keys=(
                ForeignKey("customer_id", "customer"),
                ForeignKey("restaurant_id", "restaurant"),
            ),
        ),
        Entity(
            "order_item",
            (
                _key("order_item_id", required=True),
                _key("order_id", required=True),
                _key("menu_id", required=True),
                _decimal("quantity", 5, 0),
                _decimal("price", 10, 2),
                _decimal("subtotal", 10, 2),
                *_audit_dates(),
            ),
            foreign_keys=(ForeignKey("order_id", "orders"), ForeignKey("menu_id", "menu")),
        ),
        Entity(
            "delivery",
            (
                _key("delivery_id", required=True),
                _key("order_id", required=True),
                _key("delivery_agent_id", required=True),
                _text("delivery_status"),
                _text("estimated_time"),
                *_audit_dates(),
            ),
            insert_only=("order_id", "delivery_agent_id", "created_dt"),
            foreign_keys=(
                ForeignKey("order_id", "orders", null_is_orphan=True),
                ForeignKey("delivery_agent_id", "delivery_agent", null_is_orphan=True),
            ),
        ),
    )
}

DIMENSIONS: dict[str, Dimension] = {
    d.name: d
    for d in (
        Dimension(
            "location_dim",
            "location",
            carried=("city", "state", "zipcode", "active_flag"),
            tracked=(("city", PLAIN), ("state", PLAIN), ("zipcode", ""), ("active_flag", PLAIN)),
        ),
        Dimension(
            "customer_dim",
            "customer",
            carried=("name", "mobile", "email", "gender", "dob"),
            tracked=(
                ("name", ""),
                ("mobile", ""),
                ("email", ""),
                ("gender", ""),
                ("dob", "1900-01-01"),
            ),
        ),
        Dimension(
            "restaurant_dim",
            "restaurant",
            carried=(
                "name",
                "cuisine_type",
                "pricing_for_two",
                "location_id",
                "active_flag",
                "open_status",
            ),
            tracked=(
                ("name", ""),
                ("cuisine_type", ""),
                ("pricing_for_two", 0),
                ("location_id", PLAIN),
                ("active_flag", PLAIN),
                ("open_status", ""),
            ),
        ),
        Dimension(
            "menu_dim",
            "menu",
            carried=("restaurant_id", "item_name", "price", "category", "item_type"),
            tracked=(("price", 0), ("category", ""), ("item_type", "")),
        ),
        Dimension(
            "delivery_agent_dim",
            "delivery_agent",
            carried=("name", "vehicle_type", "location_id", "status", "rating"),
            tracked=(("status", ""), ("rating", 0)),
        ),
    )
}

ADDRESS_DIM_COLUMNS = ("customer_id", "city", "state", "address_type")


def dimension_schema(dim: Dimension) -> T.StructType:
    entity = ENTITIES[dim.entity]
    fields = [T.StructField(dim.surrogate, T.LongType()), T.StructField(entity.key, T.LongType())]
    for name in dim.carried:
        fields.append(entity.column(name).field)
    fields += [
        T.StructField("eff_start_date", T.TimestampNTZType()),
        T.StructField("eff_end_date", T.TimestampNTZType()),
        T.StructField("is_current", T.BooleanType()),
    ]
    return T.StructType(fields)
