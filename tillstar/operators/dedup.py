"""Keyed deduplication and duplicate reporting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_best(rows: DataFrame, key: str, preference: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``preference``.

    Spark keeps only the best row per key in every map task (``WindowGroupLimit``, partial) before it
    shuffles, so a key that owns a third of the rows reaches its reducer as one row per map task.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(*preference))
    return rows.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def total_preference(rows: DataFrame, leading: dict[str, Column]) -> list[Column]:
    """``leading`` followed by every other column, so equal leaders still order the same way."""
    rest = [F.col(c).asc_nulls_last() for c in rows.columns if c not in leading]
    return [*leading.values(), *rest]


def key_counts(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))


def repeated_values(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: for each column, how many of its non-null values occur more than once.

    All columns share one scan and one shuffle. Comparing as text keeps the values of one column apart
    exactly as their own type does.
    """
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    counted = rows.select(F.inline(F.array(*pairs))).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("copies"))
    repeated = F.col("value").isNotNull() & (F.col("copies") > 1)
    return counted.agg(*[F.count_if(repeated & (F.col("column_name") == c)).alias(c) for c in columns])


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys on more than one row, with their row count. NULL is a key like any other."""
    return key_counts(rows, key).where(F.col("copies") > 1)
