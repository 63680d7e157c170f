"""Date parts. Two weekday numberings exist and are kept apart on purpose.

Orders number weekdays 1 (Sunday) to 7 (Saturday); the calendar dimension numbers them 0 to 6.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_day(as_of: dt.date | None) -> Column:
    """The reporting day: explicit for reproducible runs, otherwise today."""
    return F.current_date() if as_of is None else F.lit(as_of)


def load_time() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def wall_time(moment: dt.datetime | None) -> Column:
    """A zone-free timestamp, the same in every session time zone; None stands for now."""
    return load_time() if moment is None else F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def date_key(day: Column) -> Column:
    """``yyyymmdd`` as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def order_weekday(day: Column) -> Column:
    return F.dayofweek(day)


def calendar_weekday(day: Column) -> Column:
    return F.dayofweek(day) - 1


def falls_on_weekend(day: Column) -> Column:
    return F.coalesce(F.dayofweek(day).isin(1, 7), F.lit(False))


def quarter_label(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"))


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day)
