"""Text-to-type conversions where a bad value becomes NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType


def whole_number(text: Column) -> Column:
    """Integer part of decimal text: ``'7'`` and ``'7.9'`` give 7, ``'abc'`` gives NULL.

    The regular expressions only run for values the plain cast rejects.
    """
    truncated = F.regexp_extract(text, r"^\s*([+-]?\d+)\.\d*\s*$", 1).try_cast("int")
    fraction_only = F.when(text.rlike(r"^\s*[+-]?\.\d*\s*$"), F.lit(0))
    return F.coalesce(text.try_cast("int"), truncated, fraction_only)


def real_number(text: Column) -> Column:
    return text.try_cast("double")


def iso_day(text: Column) -> Column:
    """``yyyy-MM-dd`` text to a date; impossible dates such as ``9999-99-99`` give NULL.

    The shape test plus the plain cast costs a third of a pattern-driven parser.
    """
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), text.try_cast("date"))


def try_typed(value: Column, source: DataType, target: DataType) -> Column:
    """Text becomes a date only in the full ``yyyy-MM-dd`` form; a plain cast would take ``2024`` or trailing text."""
    if isinstance(target, DateType) and isinstance(source, StringType):
        return iso_day(value)
    return value.try_cast(target)


def cast_failed(value: Column, source: DataType, target: DataType) -> Column:
    """True when a present value has no representation in the target type."""
    return value.isNotNull() & try_typed(value, source, target).isNull()
