"""Published tables: written and checked before they become visible, found by name from any process.

Each is a committed table under the warehouse. Its view is SQL that reads the newest commit whenever it is used, so a view
that one process has made shows what another one publishes later.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.keys import checked_name, quoted_name
from tillstar.operators.dedup import key_counts
from tillstar.sources import monthly
from tillstar.sources.commits import KEPT_COMMITS, Commit, CommittedTable
from tillstar.sources.workspace import warehouse_root

KEPT_VERSIONS = KEPT_COMMITS


class SnapshotRejected(RuntimeError):
    """The new snapshot is empty or repeats a key; the published one is unchanged."""


@dataclass(frozen=True)
class Snapshot:
    location: str
    total_rows: int
    unique_keys: int
    latest_load: dt.datetime | None = None


def load_check(rows: DataFrame, loaded_at: str) -> DataFrame:
    """Row count and newest load time of a candidate load."""
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.max(loaded_at).alias("latest_load"))


def key_check(rows: DataFrame, key: str, loaded_at: str | None = None) -> DataFrame:
    """Rows, distinct non-null keys and newest load time. Keys are pre-counted, so a repeated key costs one row per task."""
    total, unique = F.coalesce(F.sum("copies"), F.lit(0)).alias("total_orders"), F.count(key).alias("unique_orders")
    if loaded_at is None:
        return key_counts(rows, key).agg(total, unique)
    newest = F.max(loaded_at).alias("latest_load")
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("copies"), newest)
    return counted.agg(total, unique, F.max("latest_load").alias("latest_load"))


def table(spark: SparkSession, target: str) -> CommittedTable:
    return CommittedTable(spark, f"{warehouse_root(spark)}/_published/{checked_name(target).replace('.', '/')}")


def versions(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    return table(spark, target).numbers()


def published(spark: SparkSession, target: str) -> DataFrame:
    """The newest version of a table that any process has published; it stays on that version."""
    found = table(spark, target)
    if not found.numbers():
        raise LookupError(f"{target} has not been published under {warehouse_root(spark)}")
    return found.read()


def show(spark: SparkSession, target: str) -> None:
    """Let this session, and its catalog for names with a schema, read the table by name."""
    statement = table(spark, target).statement()
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{target.replace('.', '__')}` AS {statement}")
    if "." in target:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted_name(target.rpartition('.')[0])}")
        spark.sql(f"CREATE OR REPLACE VIEW {quoted_name(target)} AS {statement}")


def key_gate(target: str, key: str, loaded_at: str | None, found: dict) -> Callable[[DataFrame], dict[str, str]]:
    """A check for a write that refuses tables without rows or with missing or repeated keys; its figures go to ``found``."""

    def check(whole: DataFrame) -> dict[str, str]:
        found.update(key_check(whole, key, loaded_at).first().asDict())
        if found["total_orders"] == 0:
            raise SnapshotRejected(f"{target}: the load produced no rows")
        if found["total_orders"] != found["unique_orders"]:
            raise SnapshotRejected(f"{target}: {key} is not unique or is missing")
        return {}

    return check


def _snapshot(held: CommittedTable, done: Commit, found: dict) -> Snapshot:
    return Snapshot(f"{held.root}@{done.number}", found["total_orders"], found["unique_orders"], found.get("latest_load"))


def replace_snapshot(
    rows: DataFrame, target: str, key: str, partition_by: tuple[str, ...] = (), loaded_at: str | None = None
) -> Snapshot:
    """Write a new version, verify volume and key uniqueness on what was written, then publish it."""
    found: dict = {}
    held = table(rows.sparkSession, target)
    done = held.write(rows, partition_by, check=key_gate(target, key, loaded_at, found))
    show(rows.sparkSession, target)
    return _snapshot(held, done, found)


def follow_snapshot(
    source: CommittedTable, target: str, key: str, build: Callable[[DataFrame], DataFrame], partition_by: tuple[str, ...], loaded_at: str | None = None
) -> tuple[Snapshot, set[str]]:
    """The same from a table laid out by month: only months that differ are written, and keys are verified over all."""
    found: dict = {}
    held = table(source.spark, target)
    done, changed = monthly.follow(source, held, build, partition_by, check=key_gate(target, key, loaded_at, found))
    if not found:
        found.update(key_check(held.read(done), key, loaded_at).first().asDict())
    show(source.spark, target)
    return _snapshot(held, done, found), changed


def save_table(
    rows: DataFrame,
    target: str,
    cluster_by: tuple[str, ...] = (),
    check: Callable[[DataFrame], dict[str, str]] | None = None,
    arranged: bool = False,
) -> str:
    """Publish as a table, laid out by ``cluster_by`` so range filters skip files, if ``check`` lets it; returns root and version.

    Rows that are ``arranged`` already, as by clustering, are written in the order they come.
    """
    held = table(rows.sparkSession, target)
    done = held.write(rows, cluster_by, check=check, arrange=not arranged)
    show(rows.sparkSession, target)
    return f"{held.root}@{done.number}"


def save_view(spark: SparkSession, statement: str, name: str) -> None:
    """A view stores nothing: its statement runs on every read and finds the newest version of what it reads."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {checked_name(name)} AS {statement}")
