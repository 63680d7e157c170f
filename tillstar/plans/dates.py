"""Calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions import calendar

# Default first day and number of days.
FIRST_DAY = dt.date(2023, 1, 1)
DAYS = 1096


def date_span(spark: SparkSession, first: dt.date = FIRST_DAY, days: int = DAYS) -> DataFrame:
    """One row ``(first_day, last_day)`` for a fixed calendar."""
    return spark.range(1).select(
        F.lit(first).alias("first_day"), F.lit(first + dt.timedelta(days=days - 1)).alias("last_day")
    )


def years_covering(rows: DataFrame, day: str) -> DataFrame:
    """One row spanning whole years around the days found in ``rows``, so no sale falls outside."""
    bounds = rows.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return bounds.select(
        F.trunc("lo", "year").alias("first_day"), F.make_date(F.year("hi"), F.lit(12), F.lit(31)).alias("last_day")
    )


def dim_date(span: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Every day of the span. Its size depends on the calendar only, never on the sales."""
    day, today = F.col("full_date"), calendar.as_of_day(as_of)
    this_year = F.year(day) == F.year(today)
    days = span.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    return days.select(
        calendar.date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        calendar.quarter_label(day).alias("quarter_label"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.weekofyear(day).alias("week_of_year"),
        calendar.iso_year(day).alias("year_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        calendar.calendar_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "E").alias("day_short"),
        calendar.falls_on_weekend(day).alias("is_weekend"),
        (day <= today).alias("is_past"),
        (this_year & (F.month(day) == F.month(today))).alias("is_current_month"),
        this_year.alias("is_current_year"),
    )
