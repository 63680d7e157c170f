"""Typed bulk load into a declared layout, tolerant of bad rows or strict."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tillstar.functions.casting import cast_failed, try_typed
from tillstar.schemas import REQUIRED
from tillstar.sources.workspace import persisted

OUTCOME = "load_outcome"
REASON = "load_reason"
SOURCE = "load_source"
LOADED, REJECTED = "loaded", "rejected"


def _faulty(rows: DataFrame, name: str, data_type: DataType) -> Column:
    failed = cast_failed(F.col(name), rows.schema[name].dataType, data_type)
    return failed | F.col(name).isNull() if name in REQUIRED else failed


def classify(rows: DataFrame, target: StructType, *carried: Column) -> DataFrame:
    """Typed columns plus an outcome per row; a rejected row also keeps its input values, as text.

    A row is rejected when any present value has no counterpart in the target type, or a required one is missing. Carried
    columns may refer to the input and to the reason.
    """
    failing = F.concat_ws(",", *[F.when(_faulty(rows, f.name, f.dataType), F.lit(f.name)) for f in target])
    source = F.struct(*[F.col(f.name).cast("string").alias(f.name) for f in target])
    return rows.withColumn(REASON, failing).select(
        *[try_typed(F.col(f.name), rows.schema[f.name].dataType, f.dataType).alias(f.name) for f in target],
        REASON,
        F.when(F.col(REASON) != "", source).alias(SOURCE),
        F.when(F.col(REASON) == "", LOADED).otherwise(REJECTED).alias(OUTCOME),
        *carried,
    )


def accepted_rows(classified: DataFrame, target: StructType) -> DataFrame:
    return classified.where(F.col(OUTCOME) == LOADED).select(*target.names)


def rejected_rows(classified: DataFrame) -> DataFrame:
    """Input values of the rejected rows and the columns at fault."""
    return classified.where(F.col(OUTCOME) == REJECTED).select(f"{SOURCE}.*", REASON)


def strict(rows: DataFrame, target: StructType) -> DataFrame:
    """Typed rows; evaluating a bad value fails the job, whatever the session's ANSI mode."""

    def typed(name: str, data_type: DataType) -> Column:
        value = F.col(name)
        complaint = F.concat(F.lit(f"column {name} cannot hold "), F.coalesce(value.cast("string"), F.lit("NULL")))
        good = try_typed(value, rows.schema[name].dataType, data_type)
        return F.when(_faulty(rows, name, data_type), F.raise_error(complaint)).otherwise(good)

    return rows.select(*[typed(f.name, f.dataType).alias(f.name) for f in target])


@dataclass(frozen=True)
class LoadResult:
    """Outcome of a bulk load. Both row sets sit in one written table."""

    table: DataFrame
    target: StructType
    rows_loaded: int
    rows_errors: int

    @property
    def loaded(self) -> DataFrame:
        return accepted_rows(self.table, self.target)

    @property
    def quarantined(self) -> DataFrame:
        return rejected_rows(self.table)


def copy_into(rows: DataFrame, target: StructType, name: str, on_error: str = "continue") -> LoadResult:
    """Load ``rows`` into a new table.

    ``continue`` keeps good rows and quarantines bad ones in a single pass: the outcome is a
    directory of the written table, so readers of either side skip the other. ``abort`` fails on the
    first bad row. No row is shuffled, and the counts come from the written files.
    """
    if on_error == "continue":
        located = classify(rows, target)
    elif on_error == "abort":
        located = strict(rows, target).withColumns(
            {REASON: F.lit(""), SOURCE: F.lit(None).cast(target), OUTCOME: F.lit(LOADED)}
        )
    else:
        raise ValueError(f"on_error must be 'continue' or 'abort', not {on_error!r}")
    table = persisted(located, name, (OUTCOME,), shuffle=False)
    counts = table.groupBy(OUTCOME).count().collect()
    rows_by_outcome = {line[OUTCOME]: line["count"] for line in counts}
    return LoadResult(table, target, rows_by_outcome.get(LOADED, 0), rows_by_outcome.get(REJECTED, 0))
