"""Figures that are compared after a load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.money import average_amount, beyond, cents, half_up_ratio

CENTS_PER_MILLION = 100_000_000


def _totals(orders: DataFrame, *distinct) -> DataFrame:
    """Spark expands rows per distinct column and deduplicates them in the map tasks, in one scan."""
    return orders.agg(
        F.count(F.lit(1)).alias("rows"),
        *distinct,
        F.min("order_date").alias("earliest_order"),
        F.max("order_date").alias("latest_order"),
        F.sum(cents(F.col("net_amount"))).alias("net_cents"),
        F.sum(beyond(F.col("net_amount"))).alias("net_rest"),
        F.count("net_amount").alias("net_rows"),
    )


def _millions():
    net, rest = F.col("net_cents"), F.col("net_rest")
    inexact = (F.coalesce(net.cast("double") / 100.0, F.lit(0.0)) + rest) / 1_000_000.0
    return F.when(rest.isNull(), half_up_ratio(net, F.lit(CENTS_PER_MILLION), 2)).otherwise(inexact)


def load_verification(orders: DataFrame) -> DataFrame:
    customers = F.count_distinct("customer_id").alias("unique_customers")
    products = F.count_distinct("product_id").alias("unique_products")
    return _totals(orders, customers, products).select(
        F.col("rows").alias("total_orders"),
        "unique_customers",
        "unique_products",
        "earliest_order",
        "latest_order",
        _millions().alias("total_revenue_m"),
        average_amount(F.col("net_cents"), F.col("net_rows"), F.col("net_rest")).alias("avg_order_value"),
    )


def load_profile(orders: DataFrame) -> DataFrame:
    return _totals(orders, F.count_distinct("customer_id").alias("unique_customers")).select(
        F.col("rows").alias("total_rows"),
        "unique_customers",
        "earliest_order",
        "latest_order",
        _millions().alias("revenue_millions"),
    )
