"""The sixteen checks a staged set must face before it is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions import text
from tillstar.operators import contracts
from tillstar.operators.contracts import WARNING, RowCheck
from tillstar.schemas import ACCEPTED_STATUSES

# Required columns, bounds and check names of the contract.
REQUIRED_COLUMNS = [
    "order_id", "customer_id", "product_id", "store_id", "category", "quantity", "unit_price", "discount_pct",
    "order_date", "status", "country", "channel", "payment", "gross_amount", "net_amount", "year", "month", "quarter",
]
VOLUME = (800_000, 1_200_000)
CARDINALITY = (0.01, 0.20)
MISSING_CATEGORY_SHARE = 0.05
UNIQUE_NAME = "order_id: globally unique"
VOLUME_NAME = "row count: within expected range"
SCHEMA_NAME = "schema: all required columns present"
CARDINALITY_NAME = "customer_id: cardinality in expected range"


def row_checks() -> list[RowCheck]:
    price, quantity, net = F.col("unit_price"), F.col("quantity"), F.col("net_amount")
    status = F.col("status")
    mandatory = ["order_id", "customer_id", "product_id", "order_date", "unit_price"]
    return [
        *[RowCheck(f"{name}: no nulls", F.col(name).isNull()) for name in mandatory],
        RowCheck("unit_price: positive and bounded", price.isNull() | ~price.between(0.01, 10_000)),
        RowCheck("quantity: valid range 1–100", quantity.isNull() | ~quantity.between(1, 100)),
        RowCheck("net_amount: always positive", net.isNull() | (net < 0.01)),
        RowCheck("status: accepted values only", status.isNull() | ~status.isin(ACCEPTED_STATUSES)),
        RowCheck("category: at least 95% populated", text.is_blank(F.col("category")), WARNING, MISSING_CATEGORY_SHARE),
        RowCheck("customer_id: format C######", text.lacks_shape(F.col("customer_id"), text.CUSTOMER_ID_SHAPE), WARNING),
        RowCheck("product_id: format P#####", text.lacks_shape(F.col("product_id"), text.PRODUCT_ID_SHAPE), WARNING),
    ]


def quality_report(
    staged: DataFrame,
    volume: tuple[int, int] = VOLUME,
    cardinality: tuple[float, float] = CARDINALITY,
) -> DataFrame:
    """``(name, success, severity, invalid_count, unexpected_percent)`` per check.

    Thirteen checks share one scan without a shuffle; key uniqueness and customer cardinality each
    read a single column. When a required column is absent only the schema line is reported.
    """
    schema = contracts.schema_report(staged, REQUIRED_COLUMNS, SCHEMA_NAME)
    if contracts.missing_columns(staged, REQUIRED_COLUMNS):
        return schema
    return contracts.combine(
        [
            contracts.row_report(staged, row_checks(), (VOLUME_NAME, *volume)),
            contracts.unique_report(staged, "order_id", UNIQUE_NAME),
            contracts.cardinality_report(staged, "customer_id", CARDINALITY_NAME, *cardinality),
            schema,
        ]
    )


def gate_passes(report: DataFrame) -> bool:
    """True when no critical check failed. Sixteen lines reach the driver as one row."""
    return contracts.verdict(report).first()["cleared"]
