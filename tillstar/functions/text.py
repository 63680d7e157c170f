"""Text clean-up for codes and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstar.schemas import ORDER_STATUSES, UNKNOWN_STATUS

# Identifier shapes.
CUSTOMER_ID_SHAPE = r"^C\d{6}$"
PRODUCT_ID_SHAPE = r"^P\d{5}$"


def label(value: Column) -> Column:
    return F.lower(F.trim(value))


def code(value: Column) -> Column:
    return F.upper(F.trim(value))


def order_status(value: Column) -> Column:
    """Cleaned status; anything outside the domain, NULL included, is ``unknown``."""
    cleaned = label(value)
    return F.when(cleaned.isin(ORDER_STATUSES), cleaned).otherwise(F.lit(UNKNOWN_STATUS))


def is_blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")


def lacks_shape(value: Column, pattern: str) -> Column:
    return value.isNull() | ~value.rlike(pattern)
