"""Staged orders as Parquet, laid out by order year and month and replaced by commits.

A month is a folder that is never changed: a run writes the months it brings, then one commit swaps them in. Until
then, and if the run dies, readers see the old set.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.schemas import STAGED_ORDERS
from tillstar.sources.commits import CommittedTable
from tillstar.sources.workspace import small_scans

LAYOUT = ("year", "month")
MAX_ROWS_PER_FILE = 5_000_000


def write_staged(orders: DataFrame, path: str, months: Collection[tuple[int, int]] | None = None, arrange: bool = True) -> int:
    """Replace the staged set, or only the given (year, month) pairs of it, and return the number of rows written.

    A given month without orders leaves the set; orders of other months are not written then.
    ``arrange=False`` is for orders that the months have brought together already.
    """
    table = CommittedTable(orders.sparkSession, path)
    if months is None:
        with small_scans(orders.sparkSession):
            return table.write(orders, LAYOUT, rows_per_file=MAX_ROWS_PER_FILE, arrange=arrange).rows
    given = {f"year={year}/month={month}" for year, month in months}
    wanted = F.concat(F.lit("year="), "year", F.lit("/month="), "month").isin(*given) if given else F.lit(False)
    with small_scans(orders.sparkSession):
        done = table.write(orders.where(wanted), LAYOUT, keep=lambda f: f.partition("/")[2] not in given, rows_per_file=MAX_ROWS_PER_FILE, arrange=arrange)
    return sum(n for f, n in done.folders.items() if f.partition("/")[2] in given)


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """The committed set, or a folder of staged Parquet files from elsewhere, other files left aside.

    ``year`` and ``month`` come back from the directory names and prune the scan. A set without rows can be read.
    """
    table = CommittedTable(spark, path)
    if table.numbers():
        return table.read()
    return spark.read.schema(STAGED_ORDERS).option("pathGlobFilter", "*.parquet").parquet(path)
