"""Sales fact: one row per order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions import calendar, keys
from tillstar.sources.clustering import clustered, curve
from tillstar.sources.workspace import by_partition

LAYOUT = ("order_year", "order_month")
# Inside a month, by day and then near in customer and product.
NEAR = ("customer_id", "product_id")
FAST_SHIPPING_DAYS = 2


def _flag(test: Column) -> Column:
    """An unknown answer counts as no."""
    return F.coalesce(test, F.lit(False))


def fct_sales(stg: DataFrame, customers: DataFrame, together: bool = False) -> DataFrame:
    """Orders with their customer's segment.

    The product dimension contributes no column and is unique per product, so it is not joined. No
    join strategy is forced: Spark broadcasts the two-column customer side only while its size is
    under the configured threshold, and past it splits a hot customer at run time (AQE skew join). ``together`` brings the
    months together for a partitioned write, before the derived columns are there, which need not move.
    """
    segments = customers.select("customer_id", "customer_segment")
    day = F.col("order_date")
    columns = {
        "sale_key": keys.surrogate_key("order_id"),
        "date_key": calendar.date_key(day),
        "customer_segment": F.coalesce("customer_segment", F.lit("unknown")),
        "discount_amount": F.coalesce("discount_amount", F.lit(0.0)),
        "net_amount": F.coalesce("net_amount", "gross_amount"),
        "is_return": _flag(F.col("order_status") == "returned"),
        "has_discount": _flag(F.col("discount_pct") > 0),
        "is_fast_shipped": _flag(F.col("days_to_ship") <= FAST_SHIPPING_DAYS),
        "dbt_updated_at": calendar.load_time(),
    }
    joined = stg.join(segments, "customer_id", "left")
    return (by_partition(joined, LAYOUT) if together else joined).withColumns(columns).select(*FACT_COLUMNS)


def arranged(fact: DataFrame, stg: DataFrame) -> DataFrame:
    """The fact in its order on disk, so that filters on day, customer or product skip row groups. Ranges of keys come from the orders."""
    return clustered(fact, (*LAYOUT, "order_date"), curve(stg, NEAR))


# Column order of the fact.
FACT_COLUMNS = [
    "sale_key", "order_id", "customer_id", "product_id", "store_id", "date_key",
    "sales_channel", "payment_method", "order_status", "country_code", "customer_segment",
    "quantity", "unit_price", "discount_pct", "discount_amount", "gross_amount", "net_amount", "days_to_ship",
    "order_date", "ship_date", "order_year", "order_month", "order_quarter", "day_of_week", "is_weekend",
    "is_return", "has_discount", "is_fast_shipped", "etl_loaded_at", "dbt_updated_at",
]
