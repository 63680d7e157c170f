"""Customer dimension: value, recency, segment and churn risk per customer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions import keys, scoring
from tillstar.functions.calendar import as_of_day, load_time
from tillstar.functions.money import average_amount, beyond, cents, from_cents
from tillstar.operators.modes import likeliest, modal_value


def customer_country_mode(stg: DataFrame) -> DataFrame:
    """Most frequent country over all orders, cancelled ones included."""
    return modal_value(stg, "customer_id", "country_code")


def customer_partials(stg: DataFrame, *by: str) -> DataFrame:
    """Sums per (customer, category, country), and per ``by`` if given; sums of any of them are the sums of their orders.

    Every figure of the dimension follows from these rows, whether they come from all orders at once or month by
    month, and a dominant customer has one row per category and country. ``stg`` holds one row per order,
    so orders are counted without a distinct.
    """
    counts = F.col("order_status") != "cancelled"
    net = F.when(counts, F.col("net_amount"))
    return stg.groupBy(*by, "customer_id", "product_category", "country_code").agg(
        F.count(F.lit(1)).alias("all_rows"),
        F.count_if(counts).alias("kept_rows"),
        F.min(F.when(counts, F.col("order_date"))).alias("first_day"),
        F.max(F.when(counts, F.col("order_date"))).alias("last_day"),
        F.count(F.when(counts, F.col("order_id"))).alias("orders"),
        F.sum(cents(net)).alias("net_cents"),
        F.sum(beyond(net)).alias("net_rest"),
        F.count(net).alias("net_rows"),
    )


def customer_metrics(partials: DataFrame) -> DataFrame:
    """Sums per customer over orders that were not cancelled. Adding up per category first makes distinct categories plain groups."""
    per_category = (
        partials.where("kept_rows > 0")
        .groupBy("customer_id", "product_category")
        .agg(
            F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
            *[F.sum(c).alias(c) for c in ("orders", "net_cents", "net_rest", "net_rows")],
        )
    )
    return per_category.groupBy("customer_id").agg(
        F.min("first_day").alias("first_order_date"),
        F.max("last_day").alias("last_order_date"),
        F.sum("orders").alias("total_orders"),
        F.sum("net_cents").alias("spend_cents"),
        F.sum("net_rest").alias("spend_rest"),
        F.sum("net_rows").alias("net_rows"),
        F.count("product_category").alias("distinct_categories"),
    )


def country_of(partials: DataFrame) -> DataFrame:
    """Most frequent country over all orders, cancelled ones included."""
    known = partials.where(F.col("country_code").isNotNull()).groupBy("customer_id", "country_code").agg(F.sum("all_rows").alias("n"))
    return known.groupBy("customer_id").agg(likeliest(F.col("country_code"), F.col("n")).alias("country_code"))


def dim_customers(stg: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return customers_from(customer_partials(stg), as_of)


def customers_from(partials: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The dimension from partial sums."""
    measured = customer_metrics(partials).join(country_of(partials), "customer_id", "left")
    spend = from_cents(F.col("spend_cents"), F.col("spend_rest"))
    silent = F.datediff(as_of_day(as_of), "last_order_date")
    return measured.select(
        keys.surrogate_key("customer_id").alias("customer_key"),
        "customer_id",
        "country_code",
        "first_order_date",
        "last_order_date",
        "total_orders",
        spend.alias("total_spend"),
        average_amount(F.col("spend_cents"), F.col("net_rows"), F.col("spend_rest")).alias("avg_order_value"),
        "distinct_categories",
        silent.alias("days_since_last_order"),
        scoring.segment(spend, F.col("total_orders")).alias("customer_segment"),
        scoring.churn_risk(silent).alias("churn_risk"),
        load_time().alias("dbt_updated_at"),
    )
