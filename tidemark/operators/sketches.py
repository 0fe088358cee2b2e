"""Approximate distinct counts and quantiles as sketches, stored per month and merged for any span of months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import gathered, read_table, replace_parts

MONTH = "_month"
#: Distinct counts are kept in 2 ** 12 registers: standard error 1.04 / 64. Quantile sketches of 400 items: ranks
#: are within 0.7 % with 99 % confidence.
REGISTERS, ITEMS = 12, 400
COUNT_ERROR, RANK_ERROR = 1.04 / 2 ** (REGISTERS / 2), 0.007
SCHEMA = T.StructType(
    [
        T.StructField("orders", T.LongType()),
        T.StructField("customers", T.BinaryType()),
        T.StructField("amounts", T.BinaryType()),
    ]
)


def sketched(orders: DataFrame, *by: str | Column) -> DataFrame:
    """Sketches of the customers and of the amounts of orders (customer_id, total_amount), by columns."""
    return orders.groupBy(*by).agg(
        F.count("*").alias("orders"),
        F.hll_sketch_agg("customer_id", REGISTERS).alias("customers"),
        F.kll_sketch_agg_double(F.col("total_amount").cast("double"), ITEMS).alias("amounts"),
    )


def refresh_months(orders: DataFrame, path: str) -> None:
    """Make the sketches of the months that ``orders`` hold whole, in place of those months' old ones."""
    month = F.expr("year(order_date) * 100 + month(order_date)").cast("int")
    rows = sketched(orders.withColumn(MONTH, month), MONTH)
    replace_parts(gathered(rows.select(*SCHEMA.fieldNames(), MONTH), MONTH), path, MONTH)


def stored_months(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, SCHEMA, MONTH)


def merged(sketches: DataFrame, by: Column) -> DataFrame:
    """One row per value of ``by``: sketches of all its months, made of theirs; no order is read again."""
    return sketches.groupBy(by).agg(
        F.sum("orders").alias("orders"),
        F.hll_union_agg("customers").alias("customers"),
        F.kll_merge_agg_double("amounts", ITEMS).alias("amounts"),
    )


def customers_of(sketch: str = "customers") -> Column:
    return F.hll_sketch_estimate(sketch)


def amount_at(rank: float, sketch: str = "amounts") -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(rank))
