"""Column layouts and value domains shared by every layer."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampNTZType

# The feed columns, the types they load as, the derived columns and the accepted domains.
RAW_COLUMNS = [
    "order_id", "customer_id", "product_id", "store_id", "category", "quantity", "unit_price",
    "discount_pct", "order_date", "ship_date", "status", "country", "channel", "payment",
]
NON_TEXT_TYPES = {
    "quantity": IntegerType(), "unit_price": DoubleType(), "discount_pct": IntegerType(),
    "order_date": DateType(), "ship_date": DateType(),
    "gross_amount": DoubleType(), "net_amount": DoubleType(), "discount_amount": DoubleType(),
    "year": IntegerType(), "month": IntegerType(), "quarter": IntegerType(), "day_of_week": IntegerType(),
    "is_weekend": BooleanType(), "days_to_ship": IntegerType(),
}
DERIVED_COLUMNS = [
    "gross_amount", "net_amount", "discount_amount", "year", "month", "quarter", "day_of_week", "is_weekend", "days_to_ship",
]
ORDER_STATUSES = ["completed", "returned", "pending", "cancelled", "processing"]
UNKNOWN_STATUS = "unknown"
CATEGORIES = ["Electronics", "Clothing", "Food & Beverage", "Sports", "Home & Garden", "Books", "Toys"]
COUNTRIES = ["IN", "US", "GB", "DE", "AU", "CA", "SG", "AE", "FR", "JP"]
CHANNELS = ["online", "in-store", "mobile"]
PAYMENTS = ["credit_card", "upi", "net_banking", "cod"]
SEGMENTS = ["platinum", "gold", "silver", "bronze"]
CHURN_RISKS = ["high", "medium", "low"]
REVENUE_TIERS = ["top_100", "top_500", "standard"]

ACCEPTED_STATUSES = [*ORDER_STATUSES, UNKNOWN_STATUS]


# The load target declares these NOT NULL.
REQUIRED = ["order_id", "customer_id", "product_id"]


def _layout(names: list[str], types: dict) -> StructType:
    return StructType([StructField(name, types.get(name, StringType())) for name in names])


# The feed is text on purpose: a malformed value must survive the scan and be typed later.
RAW_ORDERS = _layout(RAW_COLUMNS, {})
TYPED_FEED = _layout(RAW_COLUMNS, NON_TEXT_TYPES)
LOADED_ORDERS = _layout(RAW_COLUMNS + DERIVED_COLUMNS, NON_TEXT_TYPES)
STAGED_ORDERS = _layout(RAW_COLUMNS + DERIVED_COLUMNS + ["etl_loaded_at"], NON_TEXT_TYPES | {"etl_loaded_at": TimestampNTZType()})
