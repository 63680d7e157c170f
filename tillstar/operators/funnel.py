"""Row accounting of the order ETL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.money import half_up_ratio


def drop_rate(raw_rows, clean_rows):
    return half_up_ratio((raw_rows - clean_rows) * 100, raw_rows, 1)


def funnel(rows: DataFrame, key: str, valid) -> DataFrame:
    """Raw, clean and dropped rows, where clean means one row per key among the valid rows.

    Counting per key in one pass shuffles keys and counts only; rejected rows collapse into a single
    NULL group on the map side.
    """
    per_key = rows.groupBy(F.when(valid, F.col(key)).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    raw, clean = F.col("raw_rows"), F.col("clean_rows")
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"), F.count("key").alias("clean_rows")
    ).select(raw, clean, (raw - clean).alias("rows_dropped"), drop_rate(raw, clean).alias("drop_rate_pct"))
