"""Customer scoring rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Minimum spend and order count per segment, best first; days of silence per risk.
SEGMENT_FLOORS = [("platinum", 10000, 20), ("gold", 5000, 10), ("silver", 1000, 3)]
LOWEST_SEGMENT = "bronze"
HIGH_RISK_DAYS = 180
MEDIUM_RISK_DAYS = 90


def first_match(rules: list[tuple[Column, str]], default: str) -> Column:
    return F.coalesce(*[F.when(test, F.lit(name)) for test, name in rules], F.lit(default))


def segment(total_spend: Column, total_orders: Column) -> Column:
    return first_match(
        [((total_spend >= spend) & (total_orders >= orders), name) for name, spend, orders in SEGMENT_FLOORS],
        LOWEST_SEGMENT,
    )


def churn_risk(days_silent: Column) -> Column:
    return first_match(
        [(days_silent > HIGH_RISK_DAYS, "high"), (days_silent > MEDIUM_RISK_DAYS, "medium")], "low"
    )


def churn_label(last_order: Column, as_of: Column) -> Column:
    """Dashboard wording of the same rule, taken from the date; no order at all is high risk."""
    return first_match(
        [
            (last_order.isNull() | (last_order < F.date_sub(as_of, HIGH_RISK_DAYS)), "High Risk"),
            (last_order < F.date_sub(as_of, MEDIUM_RISK_DAYS), "Medium Risk"),
        ],
        "Low Risk",
    )
