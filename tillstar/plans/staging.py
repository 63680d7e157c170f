"""The staging view: loaded orders under analysis names, with obvious bad records left out.

Written as SQL, so that the same text serves a DataFrame and a view that is resolved anew on every read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

USABLE = "order_id IS NOT NULL AND customer_id IS NOT NULL AND order_date IS NOT NULL AND unit_price > 0 AND quantity > 0"

COLUMNS = {
    **{c: c for c in ("order_id", "customer_id", "product_id", "store_id")},
    "product_category": "category",
    "sales_channel": "lower(trim(channel))",
    "payment_method": "lower(trim(payment))",
    "order_status": "lower(trim(status))",
    "country_code": "upper(trim(country))",
    "quantity": "CAST(quantity AS INT)",
    "unit_price": "CAST(unit_price AS DOUBLE)",
    "discount_pct": "CAST(coalesce(discount_pct, 0) AS INT)",
    **{c: f"CAST({c} AS DOUBLE)" for c in ("gross_amount", "discount_amount", "net_amount")},
    **{c: f"CAST({c} AS DATE)" for c in ("order_date", "ship_date")},
    "days_to_ship": "CAST(days_to_ship AS INT)",
    **{f"order_{c}": f"CAST({c} AS INT)" for c in ("year", "month", "quarter")},
    "day_of_week": "CAST(day_of_week AS INT)",
    "is_weekend": "CAST(is_weekend AS BOOLEAN)",
    "etl_loaded_at": "etl_loaded_at",
    "dbt_updated_at": "CAST(current_timestamp() AS TIMESTAMP_NTZ)",
}


def _selected() -> list[str]:
    return [f"{sql} AS {name}" for name, sql in COLUMNS.items()]


def stg_orders(loaded: DataFrame) -> DataFrame:
    return loaded.where(USABLE).selectExpr(*_selected())


def statement(source: str) -> str:
    """The same over a table, view or parenthesised query."""
    return f"SELECT {', '.join(_selected())} FROM {source} WHERE {USABLE}"
