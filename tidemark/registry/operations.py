"""Single operators on stored layers, for timing: what each costs, without what leads up to it."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.entities import DIMENSIONS, ENTITIES, dimension_schema
from tidemark.operators import consumption, quality
from tidemark.operators.clean import clean_rows
from tidemark.operators.difference import layer_difference
from tidemark.operators.grouping import rollup_sets
from tidemark.operators.ranking import ranked
from tidemark.operators.scd2 import scd2
from tidemark.operators.sessions import user_sessions
from tidemark.operators.upsert import upsert
from tidemark.plans import reports
from tidemark.registry import queries, roles
from tidemark.session import configure
from tidemark.sources.shared import scratch, side_by_side, written
from tidemark.sources.tables import empty

#: Queries that are timed as they are registered, from the given tables on.
ONCE = ("layer_refresh", "change_feed_upsert")

Timed = dict[str, Callable[[], DataFrame]]


def operations(spark: SparkSession, sf_dir: str) -> Timed:
    """The operators, each ready to run on tables that are written here, once."""
    configure(spark)
    folder = scratch(spark, "bench")
    stage, clean = queries.stored_layers(spark, sf_dir, dirty=False)

    def second(name: str) -> DataFrame:
        return written(queries.second_stage(spark, sf_dir, name), f"{folder}/second/{name}")

    batches = dict(zip(ENTITIES, side_by_side(spark, [partial(second, n) for n in ENTITIES])))

    def merged(name: str) -> DataFrame:
        table = upsert(clean[name], batches[name], ENTITIES[name], queries.SECOND_TS)[0]
        return written(table, f"{folder}/merged/{name}")

    later = {d.entity: merged(d.entity) for d in DIMENSIONS.values()}

    def opened(name: str) -> DataFrame:
        dim = DIMENSIONS[name]
        first = scd2(empty(spark, dimension_schema(dim)), clean[dim.entity], dim, queries.FIRST_TS)
        return written(first, f"{folder}/dims/{name}")

    dims = dict(zip(DIMENSIONS, side_by_side(spark, [partial(opened, n) for n in DIMENSIONS])))
    dims["date_dim"] = written(consumption.date_dim(clean["orders"]), f"{folder}/dims/date_dim")
    fact = written(consumption.build_fact(clean, dims), f"{folder}/fact")
    addresses = consumption.address_dim(empty(spark, consumption.ADDRESS_DIM_SCHEMA), clean["customer_address"])
    addresses = written(addresses, f"{folder}/dims/customer_address_dim")
    usage = roles.base_table(spark, sf_dir, "events").select(
        F.col("ts").alias("start_time"),
        F.col("event_type").alias("resource"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
    )

    events = roles.base_table(spark, sf_dir, "events").withColumn("amount", F.col("value").cast("decimal(12,2)"))
    amounts = clean["orders"].select("order_id", "restaurant_id", "total_amount")
    levels = ("year", "month", "category")

    timed: Timed = {
        "monthly_revenue": lambda: reports.monthly_revenue(fact, dims["date_dim"]),
        "revenue_by_cuisine": lambda: reports.revenue_by_cuisine(fact, dims["restaurant_dim"]),
        "delivery_performance": lambda: reports.delivery_performance(fact, dims["delivery_agent_dim"]),
        "order_item_fact": lambda: consumption.build_fact(clean, dims),
        "fact_merge": lambda: consumption.upsert_fact(fact, consumption.build_fact(clean, dims)),
        "scd1_customer_address": lambda: consumption.address_dim(addresses, clean["customer_address"]),
        "date_dim": lambda: consumption.date_dim(clean["orders"]),
        "dq_checks": lambda: quality.run_checks(stage, clean, "bench", queries.FIRST_TS),
        "clean_row_counts": lambda: reports.clean_row_counts(clean),
        "daily_usage": lambda: reports.daily_usage(usage, "purchase"),
        "order_item_fact_as_of": lambda: consumption.build_fact_as_of(clean, dims),
        "revenue_rollup": lambda: reports.revenue_levels(fact, dims, levels, rollup_sets(levels)),
        "user_sessions": lambda: user_sessions(events, "user_id", "ts", "amount", queries.SESSION_GAP),
        "restaurant_ranks": lambda: ranked(amounts, "restaurant_id", "total_amount", "order_id", 4),
        "layer_difference_orders": lambda: layer_difference(stage["orders"], clean["orders"], ENTITIES["orders"]),
    }
    for name in ("orders", "order_item"):
        timed[f"clean_{name}"] = lambda name=name: clean_rows(stage[name], ENTITIES[name])[0]
    for name in ("customer", "orders", "order_item"):
        timed[f"upsert_{name}"] = lambda name=name: upsert(
            clean[name], batches[name], ENTITIES[name], queries.SECOND_TS
        )[0]
    for name in ("customer_dim", "menu_dim"):
        dim = DIMENSIONS[name]
        timed[f"scd2_{dim.entity}"] = lambda name=name, dim=dim: scd2(
            dims[name], later[dim.entity], dim, queries.SECOND_TS
        )
    return timed
