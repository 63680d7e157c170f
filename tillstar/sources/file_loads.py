"""Tolerant load of Parquet files into a declared layout: good rows, rejected rows and the list of files in one commit.

A target holds three kinds of folders: loaded rows by year and month or whatever its layout says, rejected rows with their
input values and the columns at fault, and a ledger of the files that were read. A load reads only files that
the ledger lacks, and its rows and its ledger entries become visible together, so a load that is repeated, or
repeated after it died, loads nothing twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstar.sources.bulk_load import LOADED, OUTCOME, REASON, REJECTED, SOURCE, classify
from tillstar.sources.commits import CommittedTable
from tillstar.sources.manifest import list_objects

#: Outcome of the ledger's rows.
LISTED = "listed"
FILE = "load_file"
FILE_TYPE = "struct<path: string, size_bytes: bigint, modified_at: timestamp>"


@dataclass(frozen=True)
class FileLoad:
    """What one load added."""

    files: int
    rows_loaded: int
    rows_errors: int


def _kind(outcome: str):
    return lambda folder: f"{OUTCOME}={outcome}" in folder.split("/")


def loaded_rows(table: CommittedTable, target: StructType) -> DataFrame:
    return table.read(only=_kind(LOADED)).select(*target.names)


def rejected_rows(table: CommittedTable) -> DataFrame:
    """Input values as text, the columns at fault and the file of each rejected row."""
    return table.read(only=_kind(REJECTED)).select(f"{SOURCE}.*", REASON, F.col(f"{FILE}.path").alias(FILE))


def ledger(table: CommittedTable) -> DataFrame:
    """Files that were read, with the size and time that they had then."""
    return table.read(only=_kind(LISTED)).select(f"{FILE}.*")


def source_files(spark: SparkSession, source: str) -> tuple[DataFrame, str]:
    """Parquet files of a committed table's newest commit, or of a plain folder, and the folder that their partition values count from."""
    held = CommittedTable(spark, source)
    commit = held.latest()
    if commit is None:
        return list_objects(spark, source, "*.parquet"), source
    folders = [f"{held.root}/data/{folder}" for folder in commit.folders]
    return list_objects(spark, folders, "*.parquet"), f"{held.root}/data"


def load_files(spark: SparkSession, source: str, target: StructType, table: CommittedTable) -> FileLoad:
    """Append the rows of files that are not in the table's ledger yet. Only their names come to the driver, as for any scan.

    A row is rejected when a present value has no counterpart in the target's type or a required one is missing. A column that
    the files lack counts as missing; columns beyond the target are left out. A file that was changed is a new file.
    """
    base = table.latest()
    files, root = source_files(spark, source)
    if base is not None:
        files = files.join(ledger(table), ["path", "size_bytes", "modified_at"], "left_anti")
    fresh = files.select(F.struct("path", "size_bytes", "modified_at").cast(FILE_TYPE).alias(FILE)).collect()
    if not fresh:
        return FileLoad(0, 0, 0)

    reader = spark.read.option("basePath", root).option("mergeSchema", "true")
    found = reader.parquet(*[line[FILE]["path"] for line in fresh])
    columns = [F.col(f.name) if f.name in found.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in target]
    rows = found.select(*columns, F.col("_metadata.file_path").alias(FILE))
    origin = F.struct(F.col(FILE).alias("path"), F.lit(None).alias("size_bytes"), F.lit(None).alias("modified_at")).cast(FILE_TYPE)
    judged = classify(rows, target, F.when(F.col(REASON) != "", origin).alias(FILE))
    listed = spark.createDataFrame(fresh, f"{FILE} {FILE_TYPE}").withColumn(OUTCOME, F.lit(LISTED))
    done = table.write(
        judged.unionByName(listed, allowMissingColumns=True), (OUTCOME,), keep=lambda folder: True, hidden=(OUTCOME,), arrange=False, base=base
    )
    added = {f: n for f, n in done.folders.items() if base is None or f not in base.folders}
    rows_of = {kind: sum(n for f, n in added.items() if _kind(kind)(f)) for kind in (LOADED, REJECTED)}
    return FileLoad(len(fresh), rows_of[LOADED], rows_of[REJECTED])
