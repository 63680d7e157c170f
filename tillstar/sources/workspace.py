"""Where intermediate tables live.

A cluster names a shared folder in ``spark.checkpoint.dir``. Tables written there survive the loss of
any executor and cut the lineage of whatever reads them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SCAN_BYTES, USUAL_SCAN, SMALL_SCAN = "spark.sql.files.maxPartitionBytes", "134217728b", "16m"


def shared_root(spark: SparkSession) -> str:
    """Scratch: the checkpoint folder, or else a corner of the warehouse, which executors share as well."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named.rstrip("/") if named else f"{warehouse_root(spark)}/_scratch"


def warehouse_root(spark: SparkSession) -> str:
    """Published tables, which no clean-up of scratch may touch."""
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def new_location(spark: SparkSession, name: str) -> str:
    """A location that no other write uses, so nothing is ever overwritten in place."""
    return f"{shared_root(spark)}/tillstar/{name}/{uuid.uuid4().hex}"


def by_partition(rows: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Bring rows of a partition value together before a partitioned write.

    Without it every task writes a small file into every directory. Adaptive execution sizes the
    result: small values are merged, a value that holds much of the data is split over many tasks.
    """
    return rows.hint("rebalance", *partition_by) if partition_by else rows


@contextmanager
def small_scans(spark: SparkSession) -> Iterator[None]:
    """Let scan tasks that sort what they read, as the first half of a deduplication does, stay within memory. A session's own setting is left alone."""
    before = spark.conf.get(SCAN_BYTES)
    if before != USUAL_SCAN:
        yield
        return
    spark.conf.set(SCAN_BYTES, SMALL_SCAN)
    try:
        yield
    finally:
        spark.conf.set(SCAN_BYTES, before)


def write_once(rows: DataFrame, name: str, partition_by: tuple[str, ...] = (), shuffle: bool = True) -> str:
    """Write to a fresh location and return it. ``shuffle=False`` keeps a map-only job map-only."""
    location = new_location(rows.sparkSession, name)
    arranged = by_partition(rows, partition_by) if shuffle else rows
    arranged.write.parquet(location, mode="errorifexists", partitionBy=list(partition_by))
    return location


def persisted(rows: DataFrame, name: str, partition_by: tuple[str, ...] = (), shuffle: bool = True) -> DataFrame:
    """The same rows, read back from a written table."""
    location = write_once(rows, name, partition_by, shuffle)
    return rows.sparkSession.read.schema(rows.schema).parquet(location).select(*rows.columns)
