"""The six dashboard questions over the star schema.

The fact holds one row per order, so orders are counted without a distinct. Before a dimension
is joined the fact is added up per foreign key: the join then moves one row per key and task
instead of one per sale, and a key with a third of all sales is no heavier than any other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.calendar import as_of_day
from tillstar.functions.money import average_amount, beyond, cents, from_cents, half_up_ratio
from tillstar.functions.scoring import churn_label

NET, REST = "net_cents", "net_rest"
TOP_COUNTRIES = 10


def _net(amount: str = "net_amount") -> list[Column]:
    return [F.sum(cents(F.col(amount))).alias(NET), F.sum(beyond(F.col(amount))).alias(REST)]


def _revenue() -> Column:
    return from_cents(F.sum(NET), F.sum(REST))


def _per_key(sales: DataFrame, key: str) -> DataFrame:
    return sales.groupBy(key).agg(*_net(), F.count("order_id").alias("orders"))


def _trend(sales: DataFrame, dates: DataFrame, period: Column) -> DataFrame:
    per_day = _per_key(sales, "date_key").join(dates.select("date_key", "full_date"), "date_key")
    return (
        per_day.groupBy(period.alias("month"))
        .agg(_revenue().alias("net_revenue"), F.sum("orders").alias("total_orders"))
        .orderBy("month")
    )


def revenue_trend_daily(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """The dashboard's trend: its ``month`` column holds the calendar day."""
    return _trend(sales, dates, F.col("full_date"))


def revenue_trend_monthly(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """The same trend with ``month`` as the first day of the month."""
    return _trend(sales, dates, F.trunc("full_date", "month"))


def revenue_by_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    priced = _per_key(sales, "product_id").join(products.select("product_id", "category"), "product_id")
    return (
        priced.groupBy(F.col("category").alias("product_category"))
        .agg(_revenue().alias("net_revenue"))
        .orderBy(F.col("net_revenue").desc_nulls_first(), "product_category")
    )


def segment_mix(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("customer_segment")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.col("customers").desc(), "customer_segment")
    )


def top_countries(sales: DataFrame, customers: DataFrame, limit: int = TOP_COUNTRIES) -> DataFrame:
    located = _per_key(sales, "customer_id").join(customers.select("customer_id", "country_code"), "customer_id")
    return (
        located.groupBy("country_code")
        .agg(_revenue().alias("revenue"))
        .orderBy(F.col("revenue").desc_nulls_first(), "country_code")
        .limit(limit)
    )


def channel_performance(sales: DataFrame) -> DataFrame:
    totals = sales.groupBy(F.col("sales_channel").alias("channel")).agg(
        F.count("order_id").alias("orders"),
        *_net(),
        F.count("net_amount").alias("net_rows"),
        F.sum("days_to_ship").alias("ship_days"),
        F.count("days_to_ship").alias("shipped"),
    )
    return totals.select(
        "channel",
        "orders",
        from_cents(F.col(NET), F.col(REST)).alias("revenue"),
        average_amount(F.col(NET), F.col("net_rows"), F.col(REST)).alias("average_order_value"),
        half_up_ratio(F.col("ship_days"), F.col("shipped"), 1).alias("avg_ship_days"),
    ).orderBy(F.col("revenue").desc_nulls_first(), "channel")


def churn_summary(customers: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    risk = churn_label(F.col("last_order_date"), as_of_day(as_of))
    severity = F.array_position(F.array(F.lit("High Risk"), F.lit("Medium Risk"), F.lit("Low Risk")), F.col("churn_risk"))
    return (
        customers.groupBy(risk.alias("churn_risk"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            from_cents(*(F.sum(part(F.col("total_spend"))) for part in (cents, beyond))).alias("customer_revenue"),
        )
        .orderBy(severity)
    )
