"""Declarative table tests. Each returns the offending rows; no row means the test passes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.calendar import wall_time
from tillstar.operators.dedup import duplicate_keys
from tillstar.sources.workspace import persisted


def outside(column: Column, values: Sequence) -> Column:
    """NULL passes; only a present value can be unexpected."""
    return column.isNotNull() & ~column.isin(list(values))


def breaks(column: str, expression: str, where: str | None = None) -> Column:
    """True where ``column expression`` is false; an unknown result is not a failure."""
    holds = F.expr(f"`{column}` {expression}")
    scope = F.lit(True) if where is None else F.expr(where)
    return F.coalesce(scope & ~holds, F.lit(False))


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def unique(rows: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their count."""
    return duplicate_keys(rows.where(F.col(column).isNotNull()), column)


def accepted_values(rows: DataFrame, column: str, values: Sequence) -> DataFrame:
    return rows.where(outside(F.col(column), values))


def expression_is_true(rows: DataFrame, column: str, expression: str, where: str | None = None) -> DataFrame:
    return rows.where(breaks(column, expression, where))


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Keys without a parent and the number of child rows that carry them.

    The child is counted per key before the join: the join then sees each key once, however many
    rows it has, and only distinct keys are shuffled.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("orphan_rows"))
    known = parent.select(F.col(field).alias(column))
    return keys.join(known, column, "left_anti")


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null key has no parent.

    Keys are looked up first, each once, and those without a parent are written down: they are few where a relationship mostly
    holds, so Spark sees a small table and the child's rows stay where they are.
    """
    lost = persisted(orphan_keys(child, column, parent, field).select(column), "orphan_keys", shuffle=False)
    return child.join(lost, column, "left_semi")


def freshness(
    rows: DataFrame,
    loaded_at: str,
    warn_hours: int = 24,
    error_hours: int = 48,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """One row: newest load time, its age in hours and pass / warn / error."""
    newest = F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("newest_load")
    seconds = F.timestamp_diff("SECOND", F.col("newest_load"), wall_time(as_of))
    status = (
        F.when(F.col("newest_load").isNull() | (F.col("age_seconds") > error_hours * 3600), "error")
        .when(F.col("age_seconds") > warn_hours * 3600, "warn")
        .otherwise("pass")
    )
    return (
        rows.agg(newest)
        .withColumn("age_seconds", seconds)
        .select(
            "newest_load",
            F.call_function("div", F.col("age_seconds"), F.lit(3600)).alias("age_hours"),
            status.alias("status"),
        )
    )
