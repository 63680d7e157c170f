"""The raw order feed: CSV with a header, one record per line, every field text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.schemas import RAW_COLUMNS, RAW_ORDERS


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Declared schema, no inference pass. Empty and ``""`` fields read as NULL."""
    return spark.read.csv(path, schema=RAW_ORDERS, header=True, multiLine=False)


#: Compressed text can't be split among tasks, so its files are kept small.
ROWS_PER_PACKED_FILE = 500_000


def write_feed(raw: DataFrame, path: str, packed: bool = False) -> None:
    """Text as is: the surrounding blanks of dirty labels are part of the feed. A packed feed takes a fraction of the space and reads the same."""
    writer = raw.select(*RAW_COLUMNS).write
    if packed:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_PACKED_FILE)
    writer.csv(path, mode="overwrite", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
