"""Most frequent value per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def likeliest(value: Column, weight: Column) -> Column:
    """Aggregate: the non-null value with the largest weight; the smaller value wins a tie."""
    return F.min_by(value, F.when(value.isNotNull() & (weight > 0), F.struct(-weight, value)))


def modal_value(rows: DataFrame, key: str, value: str, alias: str | None = None) -> DataFrame:
    """``(key, value)`` with the most frequent non-null value of each key.

    Counting per (key, value) first keeps a dominant key cheap: only its distinct values travel on.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(key).agg(likeliest(F.col(value), F.col("_n")).alias(alias or value))
