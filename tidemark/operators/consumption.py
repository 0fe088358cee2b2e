"""Calendar, type-1 address dimension and the order-item fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.entities import ADDRESS_DIM_COLUMNS, ENTITIES
from tidemark.operators.as_of import as_of
from tidemark.operators.joins import marked, rows_with, splittable_join
from tidemark.operators.upsert import merge, merge_stored
from tidemark.sources.shared import scratch, written

# Fixed by what the fact is to be: names, order and types.
FACT_SCHEMA = T.StructType(
    [
        T.StructField("order_item_fact_sk", T.LongType()),
        T.StructField("order_item_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_dim_sk", T.LongType()),
        T.StructField("restaurant_dim_sk", T.LongType()),
        T.StructField("location_dim_sk", T.LongType()),
        T.StructField("menu_dim_sk", T.LongType()),
        T.StructField("date_dim_sk", T.IntegerType()),
        T.StructField("delivery_agent_dim_sk", T.LongType()),
        T.StructField("delivery_status", T.StringType()),
        T.StructField("estimated_time", T.StringType()),
        T.StructField("quantity", T.DecimalType(38, 0)),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("subtotal", T.DecimalType(10, 2)),
        T.StructField("order_status", T.StringType()),
        T.StructField("payment_method", T.StringType()),
    ]
)

ADDRESS_DIM_SCHEMA = T.StructType(
    [T.StructField("customer_address_dim_sk", T.LongType()), T.StructField("address_id", T.LongType())]
    + [ENTITIES["customer_address"].column(c).field for c in ADDRESS_DIM_COLUMNS]
)
DATE_DIM_SCHEMA = T.StructType(
    [
        T.StructField("date_dim_sk", T.IntegerType()),
        T.StructField("calendar_date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("day_name", T.StringType()),
    ]
)


def date_dim(orders: DataFrame) -> DataFrame:
    """One row per day from the first to the last order date, gaps filled."""
    bounds = orders.selectExpr(
        "to_date(min(order_date)) AS first", "to_date(max(order_date)) AS last"
    )
    days = bounds.selectExpr("explode(sequence(first, last, interval 1 day)) AS calendar_date")
    return days.selectExpr(
        # yyyymmdd: readable, without collisions, the same in any engine
        "year(calendar_date) * 10000 + month(calendar_date) * 100 + day(calendar_date) AS date_dim_sk",
        "calendar_date",
        "year(calendar_date) AS year",
        "month(calendar_date) AS month",
        "day(calendar_date) AS day",
        "dayname(calendar_date) AS day_name",
    )


def address_dim(target: DataFrame, addresses: DataFrame) -> DataFrame:
    """Type-1 dimension: overwrite in place, no history. The clean surrogate numbers the rows."""
    source = addresses.selectExpr(
        "customer_address_sk AS customer_address_dim_sk",
        "address_id",
        *ADDRESS_DIM_COLUMNS,
    )
    return merge(target, source, "address_id", ADDRESS_DIM_COLUMNS)


def build_fact(clean: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """Order items joined to their order, delivery and the current dimension versions.

    The order header is completed first, at one row per order, so that the order-level dimensions
    are joined on the smaller side. Items find their dish while they are narrow and then meet the header once,
    by order; so do orders their delivery. Items whose order has no
    delivery, no calendar day, or no current dimension row drop out (inner joins). Of several
    deliveries of one order the latest counts, so an item has one fact row.
    """

    def current(name: str, *columns: str) -> DataFrame:
        return dims[name].filter("is_current").select(*columns)

    restaurants = current("restaurant_dim", "restaurant_id", "restaurant_dim_sk", "location_id").join(
        current("location_dim", "location_id", "location_dim_sk"), "location_id"
    )
    agents = current("delivery_agent_dim", "delivery_agent_id", "delivery_agent_dim_sk")
    deliveries = _latest_deliveries(clean["delivery"].join(agents, "delivery_agent_id"), "delivery_agent_dim_sk")
    headers = (
        clean["orders"]
        .selectExpr(
            "order_id",
            "customer_id",
            "restaurant_id",
            "to_date(order_date) AS calendar_date",
            "status AS order_status",
            "payment_method",
        )
        .join(dims["date_dim"].select("calendar_date", "date_dim_sk"), "calendar_date")
        .drop("calendar_date")
        .join(restaurants, "restaurant_id")
        .drop("restaurant_id", "location_id")
        .join(current("customer_dim", "customer_id", "customer_dim_sk"), "customer_id")
        .drop("customer_id")
        .join(deliveries.drop("delivery_agent_id"), "order_id")
    )
    items = _items(clean["order_item"]).join(current("menu_dim", "menu_id", "menu_dim_sk"), "menu_id").drop("menu_id")
    return _fact_rows(splittable_join(items, headers, "order_id"))


def _latest_deliveries(deliveries: DataFrame, *columns: str) -> DataFrame:
    """Of each order the delivery that was copied last, with the agent's ``columns``."""
    age = "struct(_copy_ts, _stg_load_ts, _stg_file_name, delivery_id)"
    return (
        deliveries.selectExpr(
            "order_id",
            "delivery_agent_id",
            "delivery_status",
            "estimated_time",
            *columns,
            f"row_number() OVER (PARTITION BY order_id ORDER BY {age} DESC) AS _rank",
        )
        .filter("_rank = 1")
        .drop("_rank")
    )


def _items(items: DataFrame) -> DataFrame:
    return items.selectExpr(
        "order_item_sk AS order_item_fact_sk",
        "order_item_id",
        "order_id",
        "menu_id",
        "quantity",
        "price",
        "subtotal",
    )


def _fact_rows(items: DataFrame) -> DataFrame:
    """Joined items as rows of the fact; numbers are widened last, so that they are moved as they were."""
    return items.selectExpr(
        *["CAST(quantity AS decimal(38,0)) AS quantity" if c == "quantity" else c for c in FACT_SCHEMA.fieldNames()]
    )


def build_fact_as_of(clean: dict[str, DataFrame], dims: dict[str, DataFrame], early: bool = True) -> DataFrame:
    """Order items with the dimension versions that were valid when their order was placed.

    Same rows and columns as ``build_fact`` otherwise. A restaurant's place is that of the version the order
    points to. ``early``: an order from before a key's first version points to that first one (a dimension
    row that came late); else its items drop out. The order-level versions are looked up once per order. Items find
    their dish while they are narrow; each step is written, so that no shuffle outlives it.
    """
    orders = clean["orders"].selectExpr(
        "order_id",
        "customer_id",
        "restaurant_id",
        "order_date",
        "to_date(order_date) AS calendar_date",
        "status AS order_status",
        "payment_method",
    )
    agents = dims["delivery_agent_dim"].select("delivery_agent_id").distinct()
    deliveries = _latest_deliveries(splittable_join(clean["delivery"], agents, "delivery_agent_id", "left_semi"))
    headers = orders.join(deliveries, "order_id").join(
        dims["date_dim"].select("calendar_date", "date_dim_sk"), "calendar_date"
    )
    # Every look-up asks for the keys and times of the headers, which are therefore made once.
    spark = headers.sparkSession
    headers = written(headers, scratch(spark, "headers"))

    def looked_up(rows: DataFrame, dim: str, columns: list[str], points: DataFrame) -> DataFrame:
        key = f"{dim.removesuffix('_dim')}_id"
        return as_of(rows, dims[dim], key, "order_date", columns, early=early, points=points)

    places = looked_up(headers.select("restaurant_id", "order_date").distinct(), "restaurant_dim", ["location_id"], headers)
    found = looked_up(headers, "customer_dim", ["customer_dim_sk"], headers)
    found = looked_up(found, "restaurant_dim", ["restaurant_dim_sk", "location_id"], headers)
    found = looked_up(found, "location_dim", ["location_dim_sk"], places)
    found = looked_up(found, "delivery_agent_dim", ["delivery_agent_dim_sk"], headers)
    found = written(found.drop("calendar_date", "customer_id", "restaurant_id", "location_id", "delivery_agent_id"), scratch(spark, "found"))
    # Where an order is there twice, each of its items meets both, as it would if it met them at once.
    times = found.select("order_id", "order_date").distinct()
    items = written(splittable_join(_items(clean["order_item"]), times, "order_id"), scratch(spark, "timed-items"))
    items = looked_up(items, "menu_dim", ["menu_dim_sk"], items).drop("menu_id")
    return _fact_rows(splittable_join(items, found, ["order_id", "order_date"]))


def orders_to_refresh(
    clean: dict[str, DataFrame],
    written: dict[str, DataFrame],
    renewed: dict[str, DataFrame],
    restaurants: DataFrame,
) -> DataFrame:
    """Ids of the orders whose header may have changed since the last refresh, each once.

    ``written`` holds the order and delivery rows stored since then, ``renewed`` the dimension versions
    opened since then. Each cause is a branch of its own; one without any row is left out.
    """
    moved = rows_with(restaurants.filter("is_current"), renewed["location_dim"], "location_id")
    changed = renewed["restaurant_dim"].select("restaurant_id")
    if moved is not None:
        changed = changed.unionByName(moved.select("restaurant_id"))
    causes = [
        written["orders"],
        written["delivery"],
        rows_with(clean["orders"], renewed["customer_dim"], "customer_id"),
        rows_with(clean["orders"], changed, "restaurant_id"),
        rows_with(clean["delivery"], renewed["delivery_agent_dim"], "delivery_agent_id"),
    ]
    ids = [c.select("order_id") for c in causes if c is not None]
    return reduce(DataFrame.unionByName, ids).distinct()


def items_to_refresh(items: DataFrame, written: DataFrame, orders: DataFrame, menu: DataFrame) -> DataFrame:
    """The order items whose fact row may have changed: written themselves, of such an order, of such a menu row.

    An item is left out only if its own row, its order, its delivery and the dimension versions it
    points to are all as they were. ``items`` say in ``_written`` which of them are those of ``written``. An item is
    looked at once, so those with several causes need not be reduced to one again.
    """
    found = marked(marked(items, orders, "order_id", "_of_order"), menu, "menu_id", "_of_menu")
    return found.filter("_written OR _of_order OR _of_menu").select(*written.columns)


def upsert_fact(target: DataFrame, fact: DataFrame, stored: bool = False) -> DataFrame:
    """Merge freshly joined rows by order item; a stored row keeps its order and its number.

    ``stored``: the target is read from a table, in which a writer that was killed can have left an item twice.
    """
    kept = ("order_item_fact_sk", "order_item_id", "order_id")
    overwrite = [c for c in FACT_SCHEMA.fieldNames() if c not in kept]
    together = merge_stored if stored else merge
    return together(target.select(*FACT_SCHEMA.fieldNames()), fact, "order_item_id", overwrite)
