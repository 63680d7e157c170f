"""Severity-graded data contracts evaluated in as few passes as the checks allow."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.operators.dedup import key_counts

CRITICAL = "critical"
WARNING = "warning"


@dataclass(frozen=True)
class RowCheck:
    """Rows matching ``invalid`` violate the check. Up to ``tolerated`` of all rows may do so."""

    name: str
    invalid: Column
    severity: str = CRITICAL
    tolerated: float = 0.0


def _percent(part: Column, total: Column) -> Column:
    return F.coalesce(part / F.nullif(total, F.lit(0).cast("bigint")) * F.lit(100.0), F.lit(0.0))


def _line(name: str, success: Column, severity: str, invalid: Column, percent: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        success.alias("success"),
        F.lit(severity).alias("severity"),
        invalid.cast("bigint").alias("invalid_count"),
        percent.cast("double").alias("unexpected_percent"),
    )


def _report(summary: DataFrame, lines: Sequence[Column]) -> DataFrame:
    return summary.select(F.inline(F.array(*lines)))


def row_report(rows: DataFrame, checks: Sequence[RowCheck], volume: tuple[str, int, int] | None = None) -> DataFrame:
    """All row checks, and optionally a row-count range, from one aggregate over one scan."""
    counters = [F.count_if(check.invalid).alias(f"c{i}") for i, check in enumerate(checks)]
    summary = rows.agg(F.count(F.lit(1)).alias("total"), *counters)
    total = F.col("total")
    lines = []
    for i, check in enumerate(checks):
        bad = F.col(f"c{i}")
        # Not a single row to check is a failure, and so is more than the tolerated share.
        kept = F.lit(1.0) - bad / F.nullif(total, F.lit(0).cast("bigint"))
        passed = bad == 0 if check.tolerated == 0 else kept >= F.lit(1.0 - check.tolerated)
        lines.append(_line(check.name, F.coalesce(passed & (total > 0), F.lit(False)), check.severity, bad, _percent(bad, total)))
    if volume is not None:
        name, low, high = volume
        fits = total.between(low, high)
        lines.append(_range_line(name, CRITICAL, fits, total))
    return _report(summary, lines)


def _range_line(name: str, severity: str, fits: Column, measured: Column) -> Column:
    return _line(
        name, fits, severity, F.when(fits, F.lit(0)).otherwise(measured), F.when(fits, 0.0).otherwise(100.0)
    )


def unique_report(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Counts duplicated keys (not rows) against all rows."""
    summary = key_counts(rows, key).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total"), F.count_if(F.col("copies") > 1).alias("bad")
    )
    bad, total = F.col("bad"), F.col("total")
    return _report(summary, [_line(name, (bad == 0) & (total > 0), CRITICAL, bad, _percent(bad, total))])


def cardinality_report(rows: DataFrame, key: str, name: str, low: float, high: float) -> DataFrame:
    """Distinct values (NULL counts as one) over rows must lie in [low, high]."""
    summary = key_counts(rows, key).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("values")
    )
    ratio = F.col("values") / F.nullif(F.col("total"), F.lit(0).cast("bigint"))
    fits = F.coalesce(ratio.between(low, high), F.lit(False))
    return _report(summary, [_range_line(name, WARNING, fits, F.col("values"))])


def missing_columns(rows: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(rows.columns))


def schema_report(rows: DataFrame, required: Sequence[str], name: str) -> DataFrame:
    """The schema is known without reading a row, so this line is a constant of the plan."""
    absent = len(missing_columns(rows, required))
    line = _line(name, F.lit(absent == 0), CRITICAL, F.lit(absent), F.lit(100.0 if absent else 0.0))
    return _report(rows.sparkSession.range(1), [line])


def combine(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def verdict(report: DataFrame) -> DataFrame:
    """One row: checks passed, names that failed per severity, and whether the gate opens."""

    def failed(severity: str) -> Column:
        names = F.collect_list(F.when(~F.col("success") & (F.col("severity") == severity), F.col("name")))
        return F.array_join(F.sort_array(names), ", ")

    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if("success").alias("passed"),
        failed(CRITICAL).alias("critical_failures"),
        failed(WARNING).alias("warnings"),
        (F.count_if(~F.col("success") & (F.col("severity") == CRITICAL)) == 0).alias("cleared"),
    )
