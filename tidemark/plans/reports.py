"""Report views over the fact, the dimensions, the log and the layer tables.

Distinct orders are counted after a reduction to one row per group and order. That first shuffle is
spread by order, so one month, cuisine or agent that holds most of the rows does not land in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.grouping import Sets, grouping_levels

MONEY = "decimal(38,2)"


def _zero_guarded_ratio(part: Column, whole: Column, digits: int) -> Column:
    return F.round(part / F.nullif(whole.cast("decimal(20,0)"), F.lit(0)), digits)


def monthly_revenue(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    per_order = (
        fact.join(calendar.select("date_dim_sk", "year", "month"), "date_dim_sk")
        .groupBy("year", "month", "order_id")
        .agg(F.sum("subtotal").alias("_revenue"))
    )
    totals = per_order.groupBy("year", "month").agg(
        F.sum("_revenue").cast(MONEY).alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
    )
    average = _zero_guarded_ratio(
        F.col("total_revenue").cast("decimal(28,2)"), F.col("total_orders"), 2
    )
    return totals.select(
        "year", "month", "total_revenue", "total_orders", average.alias("avg_order_value")
    ).orderBy("year", "month")


def revenue_by_cuisine(fact: DataFrame, restaurant_dim: DataFrame) -> DataFrame:
    current = restaurant_dim.filter("is_current").select("restaurant_dim_sk", "cuisine_type")
    per_order = (
        fact.join(current, "restaurant_dim_sk")
        .groupBy("cuisine_type", "order_id")
        .agg(F.sum("subtotal").alias("_revenue"))
    )
    return (
        per_order.groupBy("cuisine_type")
        .agg(
            F.sum("_revenue").cast(MONEY).alias("total_revenue"),
            F.count("order_id").alias("total_orders"),
        )
        .orderBy(F.col("total_revenue").desc())
    )


def revenue_levels(fact: DataFrame, dims: Mapping[str, DataFrame], columns: Sequence[str], sets: Sets) -> DataFrame:
    """Revenue and distinct orders of each group of each set of ``columns``, with ``grouping_id``.

    ``columns`` may be of the calendar (``year``, ``month``), of the dish (``category``), of the restaurant
    (``cuisine_type``) and of the fact itself.
    """
    for dim, key, names in (
        ("date_dim", "date_dim_sk", ("year", "month")),
        ("menu_dim", "menu_dim_sk", ("category",)),
        ("restaurant_dim", "restaurant_dim_sk", ("cuisine_type",)),
    ):
        wanted = [n for n in names if n in columns]
        if wanted:
            fact = fact.join(dims[dim].select(key, *wanted), key)
    found = grouping_levels(fact, sets, "order_id", "subtotal", columns)
    return found.select(
        *columns,
        "grouping_id",
        F.col("total").cast(MONEY).alias("total_revenue"),
        F.col("distinct_count").alias("total_orders"),
    )


def revenue_moving(fact: DataFrame, calendar: DataFrame, restaurant_dim: DataFrame) -> DataFrame:
    """Revenue per cuisine and day, the day before's, the sum of seven days and the sum so far.

    The windows see one row per cuisine and day, whatever the fact holds; days without revenue are no rows, and
    the seven days are those of the calendar.
    """
    cuisines = restaurant_dim.select("restaurant_dim_sk", "cuisine_type")
    days = calendar.select("date_dim_sk", "calendar_date")
    daily = (
        fact.join(cuisines, "restaurant_dim_sk")
        .join(days, "date_dim_sk")
        .groupBy("cuisine_type", "calendar_date")
        .agg(F.sum("subtotal").cast(MONEY).alias("revenue"))
        .withColumn("_day", F.unix_date("calendar_date"))
    )
    ordered = Window.partitionBy("cuisine_type").orderBy("_day")
    return daily.select(
        "cuisine_type",
        "calendar_date",
        "revenue",
        F.lag("revenue").over(ordered).alias("previous"),
        F.sum("revenue").over(ordered.rangeBetween(-6, 0)).cast(MONEY).alias("seven_days"),
        F.sum("revenue").over(ordered.rowsBetween(Window.unboundedPreceding, 0)).cast(MONEY).alias("so_far"),
    )


def delivery_performance(fact: DataFrame, agent_dim: DataFrame) -> DataFrame:
    """Orders per agent name, vehicle and rating; agents alike in all three are one line."""
    group = ("name", "vehicle_type", "rating")
    current = agent_dim.filter("is_current").select("delivery_agent_dim_sk", *group)

    def seen(status: str) -> Column:
        return F.max(F.when(F.col("delivery_status") == status, 1).otherwise(0))

    per_order = (
        fact.filter(F.col("order_id").isNotNull())
        .join(current, "delivery_agent_dim_sk")
        .groupBy(*group, "order_id")
        .agg(seen("Delivered").alias("_delivered"), seen("Cancelled").alias("_cancelled"))
    )
    counted = per_order.groupBy(*group).agg(
        F.count("*").alias("total_deliveries"),
        F.sum("_delivered").alias("delivered_count"),
        F.sum("_cancelled").alias("cancelled_count"),
    )
    rate = _zero_guarded_ratio(
        F.col("delivered_count").cast("decimal(20,0)") * 100, F.col("total_deliveries"), 1
    )
    return counted.select(
        F.col("name").alias("agent_name"),
        "vehicle_type",
        "total_deliveries",
        "delivered_count",
        "cancelled_count",
        rate.alias("delivered_rate_pct"),
        "rating",
    ).orderBy(F.col("total_deliveries").desc())


def top_agents(performance: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` report lines with the best delivered rate."""
    return performance.orderBy(
        F.col("delivered_rate_pct").desc_nulls_last(),
        F.col("total_deliveries").desc(),
        "agent_name",
        "vehicle_type",
        "rating",
    ).limit(n)


def daily_usage(usage: DataFrame, resource: str) -> DataFrame:
    """Daily total of one resource from rows (start_time, resource, amount), newest day first."""
    return (
        usage.filter(F.col("resource") == resource)
        .groupBy(F.date_trunc("day", "start_time").alias("usage_date"), "resource")
        .agg(F.sum("amount").alias("amount"))
        .orderBy(F.col("usage_date").desc())
    )


def newest_log_row(log: DataFrame, table: str | None = None) -> DataFrame:
    rows = log if table is None else log.filter(F.col("table_name") == table)
    return rows.orderBy(F.col("run_id").desc()).limit(1)


def remaining_null_dates(table: DataFrame) -> DataFrame:
    return table.filter(F.col("created_dt").isNull()).agg(
        F.count("*").alias("remaining_null_dates")
    )


def labelled_counts(counts: Mapping[str, DataFrame | tuple[DataFrame, str]]) -> DataFrame:
    """Rows per label; a (frame, column) pair counts the rows that fill the column."""

    def one(label: str, what) -> DataFrame:
        frame, column = what if isinstance(what, tuple) else (what, "*")
        return frame.agg(F.count(column).alias("row_count")).select(
            F.lit(label).alias("label"), "row_count"
        )

    return reduce(DataFrame.unionByName, [one(k, v) for k, v in counts.items()])


def clean_row_counts(clean: Mapping[str, DataFrame]) -> DataFrame:
    undated = clean["restaurant"].filter(F.col("created_dt").isNull())
    return labelled_counts({**clean, "restaurant_null_dates": undated})


def consumption_row_counts(tables: Mapping[str, DataFrame], fact: DataFrame) -> DataFrame:
    return labelled_counts(
        {
            **tables,
            "order_item_fact_total": fact,
            "order_item_fact_with_delivery": (fact, "delivery_agent_dim_sk"),
        }
    ).orderBy("label")
