"""Type-2 history: one row per key and validity period."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.calendar import wall_time

# Names of the validity columns appended to the tracked columns.
VERSION_ID = "dbt_scd_id"
UPDATED_AT = "dbt_updated_at"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"


def _version_columns(key: str, run_at: Column) -> dict[str, Column]:
    identity = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("|"), run_at.cast("string"))
    return {
        VERSION_ID: F.md5(identity),
        UPDATED_AT: run_at,
        VALID_FROM: run_at,
        VALID_TO: F.lit(None).cast("timestamp_ntz"),
    }


def open_versions(incoming: DataFrame, key: str, run_at: dt.datetime) -> DataFrame:
    """First run: every incoming row opens a version."""
    return incoming.withColumns(_version_columns(key, wall_time(run_at)))


def scd2_step(
    current: DataFrame,
    incoming: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_at: dt.datetime,
    close_missing: bool = True,
) -> DataFrame:
    """What a run makes of the open versions: those that stay open, those it closes and those it opens.

    A changed row closes the open version and opens a new one, an unseen key opens one, and a key
    that is gone is closed when ``close_missing``. A key that comes back opens a new version. Changes
    are null-safe. ``incoming`` has one row per key, so the join cannot multiply rows.
    """
    now = wall_time(run_at)
    fresh = open_versions(incoming, key, run_at)
    columns = current.columns
    # One struct per side keeps the two versions of a row apart without renaming every column.
    old = current.select(F.col(key).alias("_key"), F.struct(*columns).alias("was"))
    new = fresh.select(F.col(key).alias("_key"), F.struct(*columns).alias("now"))
    pair = old.join(new, "_key", "full_outer")

    was, nxt = F.col("was"), F.col("now")
    same = F.lit(True)
    for name in check_cols:
        same = same & was.getField(name).eqNullSafe(nxt.getField(name))
    gone = nxt.isNull()
    keep = was.isNotNull() & ((gone & F.lit(not close_missing)) | (~gone & same))
    closed = F.struct(
        *[(F.when(keep, was.getField(VALID_TO)).otherwise(now) if c == VALID_TO else was.getField(c)).alias(c) for c in columns]
    )
    versions = F.array(F.when(was.isNotNull(), closed), F.when(~gone & ~keep, nxt))
    return pair.select(F.explode(versions).alias("v")).where(F.col("v").isNotNull()).select("v.*")


def scd2_merge(
    history: DataFrame,
    incoming: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_at: dt.datetime,
    close_missing: bool = True,
) -> DataFrame:
    """A whole history after a run: closed versions as they are, open ones after ``scd2_step``."""
    current = history.where(F.col(VALID_TO).isNull())
    stepped = scd2_step(current, incoming, key, check_cols, run_at, close_missing)
    return history.where(F.col(VALID_TO).isNotNull()).unionByName(stepped)
