"""The SQL each registered query is compared with.

Written per table by hand rather than derived from the entity configuration, so that a mistake there
shows up as a difference. Only the role text of ``roles.py`` is shared.
"""

from __future__ import annotations

from tidemark.entities import ENTITIES
from tidemark.registry import roles

FIRST, SECOND = "2024-03-01 00:00:00", "2024-03-02 00:00:00"


def _key(column: str) -> str:
    return f"TRY_CAST(TRY_CAST({column} AS DECIMAL(38,0)) AS BIGINT) AS {column}"


def _dec(column: str, p: int, s: int) -> str:
    return f"TRY_CAST({column} AS DECIMAL({p},{s})) AS {column}"


_ISO_DATES = (
    "TRY_CAST(created_date AS TIMESTAMP) AS created_dt, TRY_CAST(modified_date AS TIMESTAMP) AS modified_dt"
)
_DAY_FIRST_DATES = (
    "try_strptime(created_date, '%d-%m-%Y %H:%M') AS created_dt,"
    " try_strptime(modified_date, '%d-%m-%Y %H:%M') AS modified_dt"
)

TYPED = {
    "location": f"{_key('location_id')}, city, state, zipcode, coalesce(active_flag = 'Y', FALSE) AS active_flag, {_ISO_DATES}",
    "customer": f"{_key('customer_id')}, name, mobile, email, gender, TRY_CAST(dob AS DATE) AS dob, {_ISO_DATES}",
    "restaurant": f"{_key('restaurant_id')}, name, cuisine_type, {_dec('pricing_for_two', 10, 2)}, restaurant_phone,"
    f" operating_hours, {_key('location_id')}, coalesce(active_flag = 'Y', FALSE) AS active_flag, open_status, {_DAY_FIRST_DATES}",
    "menu": f"{_key('menu_id')}, {_key('restaurant_id')}, item_name, description, {_dec('price', 10, 2)}, category,"
    f" coalesce(lower(availability) = 'true', FALSE) AS availability, item_type, {_ISO_DATES}",
    "delivery_agent": f"{_key('delivery_agent_id')}, name, phone, vehicle_type, {_key('location_id')}, status, gender,"
    f" {_dec('rating', 4, 2)}, {_ISO_DATES}",
    "customer_address": f"{_key('address_id')}, {_key('customer_id')}, flat_no, house_no, floor, building, landmark,"
    f" locality, city, state, pincode, coordinates, coalesce(primary_flag = 'Y', FALSE) AS primary_flag, address_type, {_ISO_DATES}",
    "orders": f"{_key('order_id')}, {_key('customer_id')}, {_key('restaurant_id')}, TRY_CAST(order_date AS TIMESTAMP) AS order_date,"
    f" {_dec('total_amount', 10, 2)}, status, payment_method, {_ISO_DATES}",
    "order_item": f"{_key('order_item_id')}, {_key('order_id')}, {_key('menu_id')}, {_dec('quantity', 5, 0)},"
    f" {_dec('price', 10, 2)}, {_dec('subtotal', 10, 2)}, {_ISO_DATES}",
    "delivery": f"{_key('delivery_id')}, {_key('order_id')}, {_key('delivery_agent_id')}, delivery_status, estimated_time, {_ISO_DATES}",
}

KEY = {
    "location": "location_id",
    "customer": "customer_id",
    "restaurant": "restaurant_id",
    "menu": "menu_id",
    "delivery_agent": "delivery_agent_id",
    "customer_address": "address_id",
    "orders": "order_id",
    "order_item": "order_item_id",
    "delivery": "delivery_id",
}

REQUIRED = {
    "location": ("location_id", "city", "state"),
    "customer": ("customer_id", "name"),
    "restaurant": ("restaurant_id", "name"),
    "menu": ("menu_id", "restaurant_id", "item_name"),
    "delivery_agent": ("delivery_agent_id", "name"),
    "customer_address": ("address_id", "customer_id"),
    "orders": ("order_id", "customer_id", "restaurant_id"),
    "order_item": ("order_item_id", "order_id", "menu_id"),
    "delivery": ("delivery_id", "order_id", "delivery_agent_id"),
}

# Names and order equal the tables this SQL describes.
# Columns beside the key, in table order; the second list is overwritten by an upsert.
OTHERS = {
    "location": "city state zipcode active_flag created_dt modified_dt",
    "customer": "name mobile email gender dob created_dt modified_dt",
    "restaurant": "name cuisine_type pricing_for_two restaurant_phone operating_hours location_id active_flag"
    " open_status created_dt modified_dt",
    "menu": "restaurant_id item_name description price category availability item_type created_dt modified_dt",
    "delivery_agent": "name phone vehicle_type location_id status gender rating created_dt modified_dt",
    "customer_address": "customer_id flat_no house_no floor building landmark locality city state pincode coordinates"
    " primary_flag address_type created_dt modified_dt",
    "orders": "customer_id restaurant_id order_date total_amount status payment_method created_dt modified_dt",
    "order_item": "order_id menu_id quantity price subtotal created_dt modified_dt",
    "delivery": "order_id delivery_agent_id delivery_status estimated_time created_dt modified_dt",
}
OVERWRITTEN = {
    "location": "city state zipcode active_flag modified_dt",
    "customer": "name mobile email gender dob modified_dt",
    "restaurant": "name cuisine_type pricing_for_two restaurant_phone operating_hours location_id active_flag"
    " open_status modified_dt",
    "menu": "restaurant_id item_name description price category availability item_type modified_dt",
    "delivery_agent": "name phone vehicle_type location_id status gender rating modified_dt",
    "customer_address": "customer_id flat_no house_no floor building landmark locality city state pincode coordinates"
    " primary_flag address_type modified_dt",
    "orders": "customer_id restaurant_id order_date total_amount status payment_method modified_dt",
    "order_item": "order_id menu_id quantity price subtotal modified_dt",
    "delivery": "delivery_status estimated_time modified_dt",
}

_TEXT_TIME = "strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
_PORTABLE = {
    "created_dt": _TEXT_TIME,
    "modified_dt": _TEXT_TIME,
    "order_date": _TEXT_TIME,
    "dob": "CAST({c} AS VARCHAR) AS {c}",
    "pricing_for_two": "CAST({c} AS DOUBLE) AS {c}",
    "price": "CAST({c} AS DOUBLE) AS {c}",
    "rating": "CAST({c} AS DOUBLE) AS {c}",
    "total_amount": "CAST({c} AS DOUBLE) AS {c}",
    "subtotal": "CAST({c} AS DOUBLE) AS {c}",
    "quantity": "CAST({c} AS DOUBLE) AS {c}",
}


def _portable(columns: list[str]) -> str:
    return ", ".join(_PORTABLE.get(c, "{c}").format(c=c) for c in columns)


def columns_of(entity: str) -> list[str]:
    return [KEY[entity], *OTHERS[entity].split()]


def first_sql(entity: str, dirty: bool = False) -> str:
    return roles.duck(roles.dirty_sql(entity) if dirty else roles.ROLE_SQL[entity])


def second_sql(entity: str) -> str:
    return roles.duck(roles.second_batch_sql(entity))


def typed(entity: str, source: str) -> str:
    return f"SELECT {TYPED[entity]} FROM ({source}) s"


def clean(entity: str, source: str) -> str:
    """Typed rows with all required columns, one per key."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in OTHERS[entity].split())
    filled = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED[entity])
    return (
        f"SELECT {', '.join(columns_of(entity))} FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY {KEY[entity]} ORDER BY {order}) AS rn"
        f" FROM ({typed(entity, source)}) t WHERE {filled}) r WHERE rn = 1"
    )


def upserted(entity: str, dirty: bool = False) -> str:
    """The clean table after both batches."""
    key = KEY[entity]
    picked = [f"coalesce(n.{key}, o.{key}) AS {key}"]
    for c in OTHERS[entity].split():
        if c in OVERWRITTEN[entity].split():
            picked.append(f"CASE WHEN n.{key} IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}")
        else:
            picked.append(f"CASE WHEN o.{key} IS NOT NULL THEN o.{c} ELSE n.{c} END AS {c}")
    picked.append(f"CASE WHEN o.{key} IS NOT NULL THEN 'batch_1.csv' ELSE 'batch_2.csv' END AS _stg_file_name")
    picked.append(f"CASE WHEN o.{key} IS NOT NULL THEN '{FIRST}' ELSE '{SECOND}' END AS _copy_ts")
    return (
        f"SELECT {', '.join(picked)} FROM ({clean(entity, first_sql(entity, dirty))}) o"
        f" FULL OUTER JOIN ({clean(entity, second_sql(entity))}) n ON n.{key} = o.{key}"
    )


def _clean_oracle(entity: str) -> str:
    return f"SELECT {_portable(columns_of(entity))} FROM ({clean(entity, first_sql(entity, True))}) c"


def _upsert_oracle(entity: str) -> str:
    return (
        f"SELECT {_portable(columns_of(entity))}, _stg_file_name, _copy_ts FROM ({upserted(entity, True)}) u"
    )


# Fixed by what each dimension tracks.
SCD2 = {
    # entity: (carried columns, change test between old o and new n)
    "location": (
        "city state zipcode active_flag",
        "o.city <> n.city OR o.state <> n.state OR coalesce(o.zipcode, '') <> coalesce(n.zipcode, '')"
        " OR o.active_flag <> n.active_flag",
    ),
    "customer": (
        "name mobile email gender dob",
        "coalesce(o.name, '') <> coalesce(n.name, '') OR coalesce(o.mobile, '') <> coalesce(n.mobile, '')"
        " OR coalesce(o.email, '') <> coalesce(n.email, '') OR coalesce(o.gender, '') <> coalesce(n.gender, '')"
        " OR coalesce(o.dob, DATE '1900-01-01') <> coalesce(n.dob, DATE '1900-01-01')",
    ),
    "restaurant": (
        "name cuisine_type pricing_for_two location_id active_flag open_status",
        "coalesce(o.name, '') <> coalesce(n.name, '') OR coalesce(o.cuisine_type, '') <> coalesce(n.cuisine_type, '')"
        " OR coalesce(o.pricing_for_two, 0) <> coalesce(n.pricing_for_two, 0) OR o.location_id <> n.location_id"
        " OR o.active_flag <> n.active_flag OR coalesce(o.open_status, '') <> coalesce(n.open_status, '')",
    ),
    "menu": (
        "restaurant_id item_name price category item_type",
        "coalesce(o.price, 0) <> coalesce(n.price, 0) OR coalesce(o.category, '') <> coalesce(n.category, '')"
        " OR coalesce(o.item_type, '') <> coalesce(n.item_type, '')",
    ),
    "delivery_agent": (
        "name vehicle_type location_id status rating",
        "coalesce(o.status, '') <> coalesce(n.status, '') OR coalesce(o.rating, 0) <> coalesce(n.rating, 0)",
    ),
}


def _scd2_oracle(entity: str) -> str:
    columns = [KEY[entity], *SCD2[entity][0].split()]
    return f"SELECT {_portable(columns)}, eff_start_date, eff_end_date, is_current FROM ({_versions(entity)}) v"


def _versions(entity: str) -> str:
    carried, test = SCD2[entity]
    key = KEY[entity]
    columns = [key, *carried.split()]
    old = ", ".join(f"o.{c}" for c in columns)
    new = ", ".join(f"n.{c}" for c in columns)
    return f"""
WITH o AS ({clean(entity, first_sql(entity))}), n AS ({upserted(entity)}),
versions AS (
  SELECT {old}, '{FIRST}' AS eff_start_date,
         CASE WHEN coalesce({test}, FALSE) THEN '{SECOND}' END AS eff_end_date,
         NOT coalesce({test}, FALSE) AS is_current
  FROM o JOIN n ON o.{key} = n.{key}
  UNION ALL
  SELECT {new}, '{SECOND}', NULL, TRUE
  FROM n LEFT JOIN o ON o.{key} = n.{key} WHERE o.{key} IS NULL OR coalesce({test}, FALSE))
SELECT * FROM versions"""


def _rejects_oracle() -> str:
    parts = []
    for entity, required in REQUIRED.items():
        missing = " OR ".join(f"{c} IS NULL" for c in required)
        reason = "concat_ws(',', " + ", ".join(
            f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in required
        ) + ")"
        parts.append(
            f"SELECT '{entity}' AS table_name, 'missing: ' || {reason} AS reject_reason, count(*) AS row_count"
            f" FROM ({typed(entity, first_sql(entity, True))}) t WHERE {missing} GROUP BY 2"
        )
    return " UNION ALL ".join(parts)


def _with_roles(*extra: str) -> str:
    """The clean tables of a first load as CTEs (``order_item`` keeps its name)."""
    ctes = [
        f"{'order_item' if e == 'order_item' else e + '_c'} AS ({typed(e, first_sql(e))})" for e in KEY
    ]
    return "WITH " + ", ".join([*ctes, *extra])


def _headers(orders: str = "orders_c", delivery: str = "delivery_c", restaurant: str = "restaurant_c") -> str:
    """What an order gives each of its items: itself, its latest delivery, its restaurant's place, its customer."""
    return f"""SELECT * FROM (
  SELECT order_id, order_date, status AS order_status, payment_method, customer_id, restaurant_id, location_id,
         cuisine_type, delivery_agent_id, agent_name, vehicle_type, rating, delivery_status, estimated_time
  FROM {orders}
  JOIN (SELECT restaurant_id, cuisine_type, location_id FROM {restaurant} SEMI JOIN location_c USING (location_id)) place
    USING (restaurant_id)
  JOIN (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY sent DESC, delivery_id DESC) AS newest
        FROM (SELECT order_id, delivery_id, delivery_agent_id, delivery_status, estimated_time, {_sent(delivery)} AS sent
              FROM {delivery}) d
        JOIN (SELECT delivery_agent_id, name AS agent_name, vehicle_type, rating FROM delivery_agent_c) a
          USING (delivery_agent_id)) handed USING (order_id)
  WHERE newest = 1) complete SEMI JOIN customer_c USING (customer_id)"""


def _sent(delivery: str) -> str:
    """When a delivery was copied, and from which file; a first load has one of each."""
    return "''" if delivery.endswith("_c") else "_copy_ts || _stg_file_name"


def _fact_cte() -> str:
    return (
        f"headers AS ({_headers()}), fact AS (SELECT order_item_id, order_id, subtotal, CAST(order_date AS DATE) AS day,"
        " cuisine_type, agent_name, vehicle_type, rating, delivery_status, delivery_agent_id"
        " FROM order_item JOIN headers USING (order_id) SEMI JOIN menu_c USING (menu_id))"
    )


_FACT_COLUMNS = {
    "customer_dim_sk": "customer_id",
    "restaurant_dim_sk": "restaurant_id",
    "location_dim_sk": "location_id",
    "menu_dim_sk": "menu_id",
    "date_dim_sk": "CAST(strftime(order_date, '%Y%m%d') AS INTEGER)",
    "delivery_agent_dim_sk": "delivery_agent_id",
}
_FACT_PLAIN = "delivery_status estimated_time quantity price subtotal order_status payment_method".split()


def _fact_rows(headers: str) -> str:
    shown = ", ".join([f"{v} AS {k}" for k, v in _FACT_COLUMNS.items()] + _FACT_PLAIN)
    return (
        f"SELECT order_item_id, order_id, {shown} FROM order_item JOIN {headers} USING (order_id)"
        " SEMI JOIN menu_c USING (menu_id)"
    )


def _order_item_fact_oracle() -> str:
    ctes = _with_roles(
        f"orders_2 AS ({upserted('orders')})",
        f"delivery_2 AS ({upserted('delivery')})",
        f"restaurant_2 AS ({clean('restaurant', first_sql('restaurant', True))})",
        f"h1 AS ({_headers()})",
        f"h2 AS ({_headers('orders_2', 'delivery_2', 'restaurant_2')})",
        f"f AS ({_fact_rows('h1')})",
        f"s AS ({_fact_rows('h2')})",
    )
    names = [*_FACT_COLUMNS, *_FACT_PLAIN]
    picked = [f"CASE WHEN s.order_item_id IS NOT NULL THEN s.{c} ELSE f.{c} END AS {c}" for c in names]
    merged = (
        "SELECT coalesce(f.order_item_id, s.order_item_id) AS order_item_id, coalesce(f.order_id, s.order_id) AS order_id, "
        + ", ".join(picked)
        + " FROM f FULL OUTER JOIN s ON f.order_item_id = s.order_item_id"
    )
    return f"{ctes} SELECT {_portable(['order_item_id', 'order_id', *names])} FROM ({merged}) u"


def _refresh_twice_oracle() -> str:
    """Every item against the tables after both loads, with the time since when each dimension row holds."""
    dims = ("location", "customer", "restaurant", "menu", "delivery_agent")
    ctes = [f"{e}_o AS ({clean(e, first_sql(e))}), {e}_c AS ({upserted(e)})" for e in KEY if e != "order_item"]
    ctes.append(f"order_item AS ({upserted('order_item')})")
    # The job's text files carry no name or time that SQL knows; of an order's two deliveries the second is later.
    ctes.append(
        "delivery_2 AS (SELECT * REPLACE ("
        f"CASE WHEN delivery_id >= 10000000 THEN '{SECOND}' ELSE _copy_ts END AS _copy_ts) FROM delivery_c)"
    )
    for e in dims:
        key, test = KEY[e], SCD2[e][1]
        changed = f"o.{key} IS NULL OR coalesce({test}, FALSE)"
        ctes.append(
            f"{e}_since AS (SELECT n.{key} AS {key}, CASE WHEN {changed} THEN '{SECOND}' ELSE '{FIRST}' END AS {e}_since"
            f" FROM {e}_c n LEFT JOIN {e}_o o ON o.{key} = n.{key})"
        )
    ctes.append(f"headers AS ({_headers('orders_c', 'delivery_2')})")
    shown = ["order_item_id", "order_id", *_FACT_PLAIN]
    joins = " ".join(f"JOIN {e}_since USING ({KEY[e]})" for e in dims)
    keys = ", ".join(f"{KEY[e]} AS {e}_id, {e}_since" for e in dims)
    return (
        f"WITH {', '.join(ctes)} SELECT {_portable(shown)}, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_dim_sk,"
        f" {keys} FROM order_item JOIN headers USING (order_id) {joins}"
    )


HISTORY = ("1990-01-01 00:00:00", "1997-07-01 00:00:00", "1999-03-01 12:30:00")


def _history(entity: str) -> str:
    """Versions after three loads: what the second load changed, the third takes back."""
    key, test = KEY[entity], f"coalesce({SCD2[entity][1]}, FALSE)"

    def row(of: str, number: int) -> str:
        place = f", {of}.location_id" if entity == "restaurant" else ""
        return f"SELECT {of}.{key} AS {key}, {of}.{key} * 4 + {number} AS {entity}_dim_sk, TIMESTAMP '{HISTORY[number]}' AS since{place}"

    old, new, same = f"{entity}_c o", f"{entity}_n n", f"o.{key} = n.{key}"
    return (
        f"{row('o', 0)} FROM {old} UNION ALL {row('n', 1)} FROM {new} LEFT JOIN {old} ON {same} WHERE o.{key} IS NULL OR {test}"
        f" UNION ALL {row('o', 2)} FROM {old} JOIN {new} ON {same} WHERE {test}"
    )


def _fact_as_of_oracle() -> str:
    dims = ("location", "customer", "restaurant", "menu", "delivery_agent")
    ctes = [f"{e}_n AS ({upserted(e)})" for e in dims] + [f"{e}_h AS ({_history(e)})" for e in dims]
    joins = " ".join(
        f"ASOF JOIN {e}_h ON {of}.{KEY[e]} = {e}_h.{KEY[e]} AND order_date >= {e}_h.since"
        for e, of in (("customer", "o"), ("restaurant", "o"), ("location", "restaurant_h"), ("delivery_agent", "d"))
    )
    ctes.append(
        "placed AS (SELECT o.order_id, order_date, o.status AS order_status, payment_method, delivery_status, estimated_time,"
        " customer_dim_sk, restaurant_dim_sk, location_dim_sk, delivery_agent_dim_sk"
        f" FROM orders_c o JOIN delivery_c d ON o.order_id = d.order_id {joins})"
    )
    shown = [c for c in _FACT_COLUMNS if c != "date_dim_sk"]
    return (
        f"{_with_roles(*ctes)} SELECT order_item_id, order_id, {', '.join(shown)},"
        f" {_FACT_COLUMNS['date_dim_sk']} AS date_dim_sk, {_portable(_FACT_PLAIN)}"
        " FROM order_item i JOIN placed USING (order_id)"
        " ASOF JOIN menu_h m ON i.menu_id = m.menu_id AND order_date >= m.since"
    )


# Halves round up on exact integers: (2 * part + whole) // (2 * whole).
_CENTS = "CAST(sum(subtotal) * 100 AS HUGEINT)"


def _monthly_revenue_oracle() -> str:
    return f"""{_with_roles(_fact_cte())}
SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
       CAST(sum(subtotal) AS DOUBLE) AS total_revenue, count(DISTINCT order_id) AS total_orders,
       CAST((2 * {_CENTS} + count(DISTINCT order_id)) // (2 * count(DISTINCT order_id)) AS DOUBLE) / 100 AS avg_order_value
FROM fact GROUP BY 1, 2"""


def _cuisine_oracle() -> str:
    return f"""{_with_roles(_fact_cte())}
SELECT cuisine_type, CAST(sum(subtotal) AS DOUBLE) AS total_revenue, count(DISTINCT order_id) AS total_orders
FROM fact GROUP BY 1"""


def _levels_oracle(columns: str, groups: str) -> str:
    placed = (
        "placed AS (SELECT order_id, subtotal, CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,"
        " category, cuisine_type, order_status, payment_method FROM order_item JOIN headers USING (order_id)"
        " JOIN (SELECT menu_id, category FROM menu_c) m USING (menu_id))"
    )
    return (
        f"{_with_roles(f'headers AS ({_headers()})', placed)} SELECT {columns}, CAST(GROUPING_ID({columns}) AS BIGINT) AS grouping_id,"
        f" CAST(sum(subtotal) AS DOUBLE) AS total_revenue, count(DISTINCT order_id) AS total_orders FROM placed GROUP BY {groups}"
    )


def _difference_oracle(sources: dict[str, str], kept: dict[str, str]) -> str:
    """Rows counted on both sides by all their columns, then by key."""
    parts = []
    for entity, key in KEY.items():
        columns = ", ".join(columns_of(entity))
        rows = (
            f"SELECT {columns}, 1 AS l, 0 AS r FROM ({typed(entity, sources[entity])}) s"
            f" UNION ALL SELECT {columns}, 0, 1 FROM ({kept[entity]}) c"
        )
        parts.append(
            f"SELECT '{entity}' AS table_name, {key} AS key, sum(l)::BIGINT AS stage_rows, sum(r)::BIGINT AS clean_rows,"
            " sum(least(l, r))::BIGINT AS equal_rows, sum(greatest(l - r, 0))::BIGINT AS only_in_stage,"
            " sum(greatest(r - l, 0))::BIGINT AS only_in_clean"
            f" FROM (SELECT {columns}, sum(l) AS l, sum(r) AS r FROM ({rows}) u GROUP BY ALL) g GROUP BY ALL"
        )
    return (
        "SELECT *, CASE WHEN key IS NULL THEN 'without a key' WHEN clean_rows = 0 THEN 'missing' WHEN stage_rows = 0 THEN 'not staged'"
        " WHEN only_in_clean = 0 THEN 'repeated' WHEN only_in_stage > 0 THEN 'changed' ELSE 'surplus' END AS kind"
        f" FROM ({' UNION ALL '.join(parts)}) d WHERE only_in_stage > 0 OR only_in_clean > 0"
    )


def _performance_sql() -> str:
    delivered = "count(DISTINCT CASE WHEN delivery_status = 'Delivered' THEN order_id END)"
    cancelled = "count(DISTINCT CASE WHEN delivery_status = 'Cancelled' THEN order_id END)"
    total = "count(DISTINCT order_id)"
    return f"""{_with_roles(_fact_cte())}
SELECT agent_name, vehicle_type, {total} AS total_deliveries, {delivered} AS delivered_count,
       {cancelled} AS cancelled_count,
       CAST((2000 * {delivered} + {total}) // (2 * {total}) AS DOUBLE) / 10 AS delivered_rate_pct,
       CAST(rating AS DOUBLE) AS rating
FROM fact GROUP BY agent_name, vehicle_type, rating"""


LOST = {e: ("zipcode" if e == "location" else "created_date", "zipcode" if e == "location" else "created_dt") for e in KEY}
FOREIGN = {
    # child: (column, parent, parent key, does a NULL reference count)
    "location": (),
    "customer": (),
    "restaurant": (("location_id", "location", "location_id", False),),
    "menu": (("restaurant_id", "restaurant", "restaurant_id", False),),
    "delivery_agent": (("location_id", "location", "location_id", False),),
    "customer_address": (("customer_id", "customer", "customer_id", False),),
    "orders": (
        ("customer_id", "customer", "customer_id", False),
        ("restaurant_id", "restaurant", "restaurant_id", False),
    ),
    "order_item": (("order_id", "orders", "order_id", False), ("menu_id", "menu", "menu_id", False)),
    "delivery": (
        ("order_id", "orders", "order_id", True),
        ("delivery_agent_id", "delivery_agent", "delivery_agent_id", True),
    ),
}


def _resent_checks_sql() -> str:
    """Every stage row twice, two tables with faults; keys count once, faulty rows each."""
    sources = {}
    for entity in KEY:
        once = first_sql(entity, entity in ("location", "delivery"))
        sources[entity] = f"SELECT * FROM ({once}) a UNION ALL SELECT * FROM ({once}) b"
    rows_in = {
        entity: f"(SELECT count(DISTINCT {KEY[entity]}) FILTER ({' AND '.join(f'{c} IS NOT NULL' for c in REQUIRED[entity])})"
        f" + count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in REQUIRED[entity])})"
        f" FROM ({typed(entity, sources[entity])}) t)"
        for entity in KEY
    }
    return _checks_over(sources, "resent", FIRST, rows_in=rows_in)


def _checks_sql(dirty: bool, ts: str, last: int = 0) -> str:
    return _checks_over({e: first_sql(e, dirty) for e in KEY}, "dirty" if dirty else "clean", ts, last)


def _checks_over(
    sources: dict[str, str], batch: str, ts: str, last: int = 0, rows_in: dict[str, str] | None = None
) -> str:
    ctes, rows = [], []
    for entity, key in KEY.items():
        ctes.append(f"{batch}_s_{entity} AS ({sources[entity]})")
        ctes.append(f"{batch}_c_{entity} AS ({clean(entity, sources[entity])})")
    for number, (entity, key) in enumerate(KEY.items(), start=1):
        stage, table = f"{batch}_s_{entity}", f"{batch}_c_{entity}"
        text, value = LOST[entity]
        lost = (
            f"(SELECT count(*) FROM {stage} s JOIN {table} c"
            f" ON TRY_CAST(TRY_CAST(s.{key} AS DECIMAL(38,0)) AS BIGINT) = c.{key}"
            f" WHERE s.{text} IS NOT NULL AND c.{value} IS NULL)"
        )
        counts, details = [], []
        for i, (column, parent, parent_key, nulls) in enumerate(FOREIGN[entity]):
            guard = "" if nulls else f"c.{column} IS NOT NULL AND "
            counts.append(
                f"(SELECT count(*) FROM {table} c LEFT JOIN {batch}_c_{parent} p ON c.{column} = p.{parent_key}"
                f" WHERE {guard}p.{parent_key} IS NULL) AS fk{i}"
            )
            details.append(
                f"'{column}:' || CASE WHEN fk{i} = 0 THEN 'PASS' ELSE 'FAIL(' || CAST(fk{i} AS VARCHAR) || ')' END"
            )
        zero = " AND ".join(f"fk{i} = 0" for i in range(len(counts))) or "TRUE"
        status = f"CASE WHEN {zero} THEN 'PASS' ELSE 'FAIL' END" if counts else "'N/A'"
        detail = " || ';' || ".join(details) if details else "CAST(NULL AS VARCHAR)"
        inner = ", ".join(
            [
                f"{(rows_in or {}).get(entity, f'(SELECT count(*) FROM {stage})')} AS rows_in",
                f"(SELECT count(*) FROM {table}) AS rows_out",
                f"{lost} AS lost",
                *counts,
            ]
        )
        rows.append(
            f"SELECT CAST({last + number} AS BIGINT) AS run_id, 'stage_to_clean' AS layer_transition,"
            f" '{entity}' AS table_name, rows_in, rows_out,"
            f" CASE WHEN lost = 0 THEN 'PASS' ELSE 'FAIL' END AS null_check_status, {status} AS fk_check_status,"
            f" {detail} AS fk_check_detail,"
            f" CASE WHEN rows_in = rows_out AND lost = 0 AND {zero} THEN 'PASS' ELSE 'FAIL' END AS overall_status,"
            f" '{ts}' AS run_ts, '{batch}' AS batch_id FROM (SELECT {inner}) m"
        )
    return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(rows)


def _gate_row(fails: str) -> str:
    return (
        f"CASE WHEN {fails} > 0 THEN 'SKIPPED' ELSE 'OK' END AS status, {fails} AS fail_count,"
        f" CASE WHEN {fails} > 0 THEN 'refresh held back: ' || CAST({fails} AS VARCHAR) || ' failed check(s)'"
        " ELSE 'refresh may run' END AS message"
    )


def _gate_oracle() -> str:
    log = _checks_sql(True, FIRST)
    count = f"SELECT count(*) AS n FROM ({log}) l WHERE overall_status = 'FAIL' AND CAST(run_ts AS TIMESTAMP) >= "
    return (
        f"SELECT 'at_bound' AS moment, {_gate_row('n')} FROM ({count} TIMESTAMP '2024-03-01 00:00:00') a"
        f" UNION ALL SELECT 'after_bound', {_gate_row('n')} FROM ({count} TIMESTAMP '2024-03-01 00:00:01') b"
    )


def _latest_oracle() -> str:
    columns = "table_name, rows_in, rows_out, null_check_status, fk_check_status, overall_status, run_ts"
    return (
        f"SELECT {columns} FROM (SELECT * FROM ({_checks_sql(True, FIRST)}) a"
        f" UNION ALL SELECT * FROM ({_checks_sql(False, SECOND, 9)}) b) l"
        " QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY run_id DESC) = 1"
    )


def _clean_counts_oracle() -> str:
    parts = [
        f"SELECT '{e}' AS label, count(*) AS row_count FROM ({clean(e, first_sql(e, True))}) c" for e in KEY
    ]
    parts.append(
        "SELECT 'restaurant_null_dates', count(*) FROM"
        f" ({clean('restaurant', first_sql('restaurant', True))}) c WHERE created_dt IS NULL"
    )
    return " UNION ALL ".join(parts)


def _consumption_counts_oracle() -> str:
    dims = ("location", "customer", "restaurant", "menu", "delivery_agent", "customer_address")
    parts = [f"SELECT '{e}_dim' AS label, count(*) AS row_count FROM {e}_c" for e in dims]
    parts.append(
        "SELECT 'date_dim', date_diff('day', min(order_date)::DATE, max(order_date)::DATE) + 1 FROM orders_c"
    )
    parts.append("SELECT 'order_item_fact_total', count(*) FROM fact")
    parts.append("SELECT 'order_item_fact_with_delivery', count(delivery_agent_id) FROM fact")
    return f"{_with_roles(_fact_cte())} " + " UNION ALL ".join(parts)


def _backfill_oracle() -> str:
    dirty = first_sql("restaurant", True)
    return f"""
WITH c AS ({clean('restaurant', dirty)}),
s AS (SELECT {_key('restaurant_id')}, try_strptime(created_date, '%Y-%m-%d %H:%M:%S') AS new_created,
             try_strptime(modified_date, '%Y-%m-%d %H:%M:%S') AS new_modified FROM ({dirty}) d)
SELECT c.restaurant_id, c.name,
       strftime(CASE WHEN s.restaurant_id IS NOT NULL THEN new_created ELSE c.created_dt END, '%Y-%m-%d %H:%M:%S') AS created_dt,
       strftime(CASE WHEN s.restaurant_id IS NOT NULL THEN new_modified ELSE c.modified_dt END, '%Y-%m-%d %H:%M:%S') AS modified_dt
FROM c LEFT JOIN s ON c.restaurant_id = s.restaurant_id"""


TAGGED = {
    "customer": ("mobile", "email", "gender", "dob"),
    "restaurant": ("restaurant_phone",),
    "delivery_agent": ("phone", "gender"),
}


def _masked(entity: str, columns: list[str], hide: bool = True) -> str:
    shown = []
    for c in columns:
        if hide and c == "dob":
            shown.append("CAST(NULL AS VARCHAR) AS dob")
        elif hide and c in TAGGED[entity]:
            shown.append(f"CASE WHEN {c} IS NOT NULL THEN '***MASKED***' END AS {c}")
        else:
            shown.append(_portable([c]))
    return ", ".join(shown)


def _masked_oracle(entity: str, hide: bool) -> str:
    return f"SELECT {_masked(entity, columns_of(entity), hide)} FROM ({typed(entity, first_sql(entity))}) t"


def _masked_dimension_oracle(entity: str) -> str:
    columns = [KEY[entity], *SCD2[entity][0].split()]
    return f"SELECT {_masked(entity, columns)}, eff_start_date, eff_end_date, is_current FROM ({_versions(entity)}) v"


def _surrogates_oracle() -> str:
    parts = []
    for entity, key in KEY.items():
        both = f"SELECT count(*) FROM ({upserted(entity, True)}) u"
        first = f"SELECT count(*) FROM ({clean(entity, first_sql(entity, True))}) c"
        parts.append(f"SELECT '{entity}' AS table_name, ({both}) AS row_count, ({both}) AS numbers, ({first}) AS kept")
    return " UNION ALL ".join(parts)


def _two_files_oracle() -> str:
    """Keys that both files hold come from the later file."""
    early, late = (clean("customer", q) for q in (roles.duck(roles.ROLE_SQL["customer"]), second_sql("customer")))
    columns = _portable(columns_of("customer"))
    return (
        f"WITH late AS ({late}) SELECT {columns}, 'part_10.csv' AS _stg_file_name, '{SECOND}' AS _copy_ts FROM late"
        f" UNION ALL SELECT {columns}, 'part_9.csv', '{SECOND}' FROM ({early}) e ANTI JOIN late USING (customer_id)"
    )


def _backfill_resent_oracle() -> str:
    """Even keys came twice; the row whose remaining columns sort last wins, and the names decide."""
    once = typed("restaurant", first_sql("restaurant"))
    again = "restaurant_id % 2 = 0"
    time = "strftime({}, '%Y-%m-%d %H:%M:%S')"
    return (
        f"SELECT restaurant_id, CASE WHEN {again} THEN name || ' b' ELSE name END AS name,"
        f" CASE WHEN {again} THEN '2020-01-01 08:00:00' ELSE {time.format('created_dt')} END AS created_dt,"
        f" CASE WHEN {again} THEN '2030-12-31 08:00:00' ELSE {time.format('modified_dt')} END AS modified_dt FROM ({once}) t"
    )


def _stage_extracts_oracle() -> str:
    columns = [f"nullif({c}, '') AS {c}" for c in ENTITIES["customer_address"].stage_schema().fieldNames()]
    tricky = roles.duck(roles.tricky_sql("customer_address"))
    return f"SELECT {', '.join(columns)}, TRUE AS from_csv, TRUE AS timed, TRUE AS well_formed FROM ({tricky}) s"


def _malformed_oracle() -> str:
    return (
        "SELECT order_id, customer_id, CASE WHEN order_id % 5 IN (1, 2) THEN 'malformed line' ELSE 'loaded' END AS outcome"
        f" FROM ({typed('orders', first_sql('orders'))}) t"
    )


NESTED = """
WITH d AS (
  SELECT *, CASE WHEN event_id % 11 = 3 THEN 'no JSON object' WHEN event_id % 19 = 7 THEN 'wrong type: attributes'
                 WHEN event_id % 17 = 5 THEN 'missing: event_id' ELSE 'loaded' END AS outcome FROM events
)
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen, user_id, 's' || (user_id % 3) AS segment, 'd' || day(ts) AS last_tag,
       CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
       CASE WHEN event_id % 7 = 0 THEN '{"v":"' || event_type || '"}' END AS rescued, outcome, CAST(1 AS BIGINT) AS documents
FROM d WHERE outcome = 'loaded'
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, outcome, count(*) FROM d WHERE outcome <> 'loaded' GROUP BY outcome"""


def _moving_oracle() -> str:
    return f"""{_with_roles(_fact_cte())}, daily AS (
  SELECT cuisine_type, day, sum(subtotal) AS revenue FROM fact GROUP BY 1, 2
)
SELECT cuisine_type, CAST(day AS VARCHAR) AS calendar_date, CAST(revenue AS DOUBLE) AS revenue,
       CAST(lag(revenue) OVER w AS DOUBLE) AS previous,
       CAST(sum(revenue) OVER (PARTITION BY cuisine_type ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS DOUBLE) AS seven_days,
       CAST(sum(revenue) OVER (PARTITION BY cuisine_type ORDER BY day ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS so_far
FROM daily WINDOW w AS (PARTITION BY cuisine_type ORDER BY day)"""


def _ranks_oracle() -> str:
    return f"""{_with_roles()}, placed AS (
  SELECT order_id, cuisine_type, CAST(floor(total_amount / 1000) AS BIGINT) AS amount
  FROM orders_c JOIN (SELECT restaurant_id, cuisine_type FROM restaurant_c) r USING (restaurant_id)
)
SELECT *, row_number() OVER o AS row_number, rank() OVER v AS rank, dense_rank() OVER v AS dense_rank,
       percent_rank() OVER v AS percent_rank, ntile(4) OVER o AS tile
FROM placed WINDOW o AS (PARTITION BY cuisine_type ORDER BY amount DESC NULLS LAST, order_id),
                   v AS (PARTITION BY cuisine_type ORDER BY amount DESC NULLS LAST)"""


def _bands_oracle() -> str:
    return f"""{_with_roles()}, bands AS (
  SELECT item_type AS band, min(price) AS low,
         CAST(min(price) + 7 * CAST(regexp_replace(item_type, '[^0-9]', '', 'g') AS INTEGER) - 3 AS DECIMAL(12,2)) AS high
  FROM menu_c GROUP BY item_type
)
SELECT band, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high, count(*) AS dishes, CAST(sum(price) AS DOUBLE) AS prices
FROM bands JOIN menu_c ON price BETWEEN low AND high GROUP BY 1, 2, 3"""


def _sketches_oracle() -> str:
    return (
        f"{_with_roles()} SELECT CAST(year(order_date) AS INTEGER) AS year, count(*) AS orders, count(DISTINCT customer_id) AS customers,"
        " TRUE AS customers_within, TRUE AS merged_near_direct, TRUE AS median_within FROM orders_c GROUP BY 1"
    )


def _gate_batch_oracle() -> str:
    logs = {"clean": _checks_sql(False, SECOND, 9), "dirty": _checks_sql(True, FIRST)}
    parts = [
        f"SELECT '{b}' AS batch, {_gate_row('n')} FROM (SELECT count(*) AS n FROM ({q}) l WHERE overall_status = 'FAIL') c"
        for b, q in logs.items()
    ]
    parts.append("SELECT 'none', 'SKIPPED', CAST(0 AS BIGINT), 'refresh held back: 0 of 9 tables checked'")
    return " UNION ALL ".join(parts)


def _usage_stream_oracle() -> str:
    """What comes late: its day ended two days or more before the last time of the deliveries before its own."""
    return """
WITH e AS (
  SELECT *, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS amount, least(2, (day(ts) - 1) // 10) AS own FROM events
), d AS (
  SELECT *, least(2, own + CASE WHEN event_id % 20 = 7 THEN 1 ELSE 0 END) AS delivery FROM e
), marks AS (
  SELECT n.delivery, max(d.ts) - INTERVAL 2 DAY AS mark FROM (SELECT DISTINCT delivery FROM d) n JOIN d ON d.delivery < n.delivery GROUP BY 1
), told AS (
  SELECT d.*, coalesce(date_trunc('day', ts) + INTERVAL 1 DAY <= mark, FALSE) AS late FROM d LEFT JOIN marks USING (delivery)
)
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS usage_date, event_type AS resource,
       CAST(sum(CAST(value AS DECIMAL(12,2))) FILTER (NOT late) AS DOUBLE) AS amount, count(*) FILTER (NOT late) AS events,
       CAST(sum(CAST(value AS DECIMAL(12,2))) FILTER (late) AS DOUBLE) AS late_amount, count(*) FILTER (late) AS late_events
FROM told GROUP BY 1, 2"""


SESSIONS = """
WITH paused AS (
  SELECT *, coalesce(ts - lag(ts) OVER w > INTERVAL 6 HOUR, TRUE) AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), numbered AS (
  SELECT *, sum(fresh::INT) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS number FROM paused
)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_end,
       count(*) AS events, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS amount
FROM numbered GROUP BY user_id, number"""


def _delivered_oracle() -> str:
    return (
        f"{_with_roles()}, d AS (SELECT order_id, created_dt + to_hours(order_id % 7) AS delivered_at FROM delivery_c)"
        " SELECT o.order_id, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS ordered_at, strftime(delivered_at, '%Y-%m-%d %H:%M:%S') AS delivered_at"
        " FROM orders_c o LEFT JOIN d ON o.order_id = d.order_id"
        " AND delivered_at BETWEEN order_date - INTERVAL 1 HOUR AND order_date + INTERVAL 3 HOUR"
    )


def all_oracles() -> dict[str, str]:
    sql = {f"clean_{e}": _clean_oracle(e) for e in KEY}
    sql |= {f"upsert_{e}": _upsert_oracle(e) for e in KEY}
    sql |= {f"scd2_{e}": _scd2_oracle(e) for e in SCD2}
    performance = _performance_sql()
    blocked = f"(SELECT count(*) FROM ({_checks_sql(True, FIRST)}) l WHERE overall_status = 'FAIL')"
    return sql | {
        "upsert_rejects": _rejects_oracle(),
        "change_feed_upsert": """
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_id, event_type,
       CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_id % 2 ORDER BY ts DESC, event_id DESC) AS rn,
             max(event_id % 2) OVER (PARTITION BY user_id) AS last_slice FROM events) e
WHERE rn = 1 AND event_id % 2 = last_slice""",
        "scd1_customer_address": f"SELECT address_id, customer_id, city, state, address_type FROM ({upserted('customer_address')}) u",
        "date_dim": f"""
WITH o AS ({typed('orders', first_sql('orders'))}),
d AS (SELECT CAST(unnest(generate_series(min(order_date)::DATE::TIMESTAMP, max(order_date)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM o)
SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_dim_sk, CAST(day AS VARCHAR) AS calendar_date,
       CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
       CAST(extract('day' FROM day) AS INTEGER) AS day, strftime(day, '%a') AS day_name FROM d""",
        "order_item_fact": _order_item_fact_oracle(),
        "order_item_fact_as_of": _fact_as_of_oracle(),
        "dq_checks": _checks_sql(False, FIRST),
        "dq_checks_dirty": _checks_sql(True, FIRST),
        "dq_gate": _gate_oracle(),
        "latest_dq_status": _latest_oracle(),
        "newest_dq_row": f"SELECT * FROM ({_checks_sql(True, FIRST)}) l WHERE table_name = 'restaurant'",
        "monthly_revenue": _monthly_revenue_oracle(),
        "layer_refresh": _monthly_revenue_oracle(),
        "revenue_by_cuisine": _cuisine_oracle(),
        "revenue_rollup": _levels_oracle("year, month, category", "ROLLUP (year, month, category)"),
        "revenue_cube": _levels_oracle("cuisine_type, category, order_status", "CUBE (cuisine_type, category, order_status)"),
        "revenue_grouping_sets": _levels_oracle(
            "year, cuisine_type, payment_method",
            "GROUPING SETS ((year, cuisine_type), (payment_method), (cuisine_type, payment_method))",
        ),
        "layer_difference": _difference_oracle(
            {e: first_sql(e, True) for e in KEY}, {e: clean(e, first_sql(e, True)) for e in KEY}
        ),
        "layer_difference_resent": _difference_oracle(
            {e: f"SELECT * FROM ({first_sql(e)}) a UNION ALL SELECT * FROM ({second_sql(e)}) b" for e in KEY},
            {e: upserted(e) for e in KEY},
        ),
        "delivery_performance": performance,
        "top_agents": f"SELECT * FROM ({performance}) p ORDER BY delivered_rate_pct DESC, total_deliveries DESC,"
        " agent_name, vehicle_type, rating LIMIT 5",
        "daily_usage": """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS usage_date, event_type AS resource,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS amount
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2""",
        "revenue_moving": _moving_oracle(),
        "restaurant_ranks": _ranks_oracle(),
        "menu_price_band": _bands_oracle(),
        "order_sketches": _sketches_oracle(),
        "stage_nested": NESTED,
        "daily_usage_stream": _usage_stream_oracle(),
        "user_sessions": SESSIONS,
        "user_sessions_stream": SESSIONS,
        "orders_delivered_stream": _delivered_oracle(),
        "clean_row_counts": _clean_counts_oracle(),
        "consumption_row_counts": _consumption_counts_oracle(),
        "backfill_dates": _backfill_oracle(),
        "remaining_null_dates": "SELECT count(*) AS remaining_null_dates FROM"
        f" ({clean('restaurant', first_sql('restaurant', True))}) c WHERE created_dt IS NULL",
        "masked_customer": _masked_oracle("customer", True),
        "masked_restaurant": _masked_oracle("restaurant", True),
        "masked_delivery_agent": _masked_oracle("delivery_agent", True),
        "unmasked_customer": _masked_oracle("customer", False),
        "masked_customer_dim": _masked_dimension_oracle("customer"),
        "masked_delivery_agent_dim": _masked_dimension_oracle("delivery_agent"),
        "masked_stored_customer": f"SELECT {_masked('customer', columns_of('customer'))} FROM ({upserted('customer', True)}) u",
        "surrogates_stable": _surrogates_oracle(),
        "upsert_two_files": _two_files_oracle(),
        "backfill_resent": _backfill_resent_oracle(),
        "stage_extracts": _stage_extracts_oracle(),
        "stage_malformed": _malformed_oracle(),
        "dq_checks_resent": _resent_checks_sql(),
        "dq_gate_batch": _gate_batch_oracle(),
        "layer_refresh_twice": _refresh_twice_oracle(),
        "layer_refresh_blocked": f"SELECT {_gate_row('n')}, CAST(0 AS BIGINT) AS fact_rows FROM (SELECT {blocked} AS n) b",
    }
