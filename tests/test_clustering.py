"""The fact's order on disk: what statistics let a reader skip."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillstar.sources import clustering
from tillstar.sources.commits import CommittedTable


@pytest.fixture(scope="module")
def orders(spark):
    n = F.col("id")
    return spark.range(0, 40_000, 1, 4).select(
        F.lit(2024).alias("order_year"), (1 + n % 2).cast("int").alias("order_month"),
        F.expr("date_add(make_date(2024, 1 + int(id % 2), 1), int(abs(xxhash64(id, 'day')) % 3))").alias("order_date"),
        F.format_string("C%06d", F.abs(F.xxhash64(n, F.lit("c"))) % 3000).alias("customer_id"),
        F.format_string("P%05d", F.abs(F.xxhash64(n, F.lit("p"))) % 800).alias("product_id"), n.alias("order_id"),
    ).cache()


def groups_to_read(root, **wanted):
    """Row groups whose statistics allow all wanted values, and how many there are."""
    read = total = 0
    for file in glob.glob(f"{root}/data/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        for i in range(meta.num_row_groups):
            group = meta.row_group(i)
            stats = {group.column(j).path_in_schema: group.column(j).statistics for j in range(group.num_columns)}
            total += 1
            read += all(stats[c].min <= v <= stats[c].max for c, v in wanted.items())
    return read, total


def test_one_day_and_one_customer_or_product_read_few_row_groups(spark, orders, tmp_path):
    spark.conf.set("parquet.block.size", str(8 << 10))
    try:
        wanted = orders.where("order_date = date'2024-01-02'").select("order_date", "customer_id", "product_id").first()
        place = clustering.curve(orders, ("customer_id", "product_id"))
        tables = {
            name: CommittedTable(spark, str(tmp_path / name)) for name in ("plain", "clustered")
        }
        tables["plain"].write(orders, ("order_year", "order_month"))
        tables["clustered"].write(clustering.clustered(orders, ("order_year", "order_month", "order_date"), place), ("order_year", "order_month"), arrange=False)
    finally:
        spark.conf.unset("parquet.block.size")
    assert sorted(tables["plain"].read().collect()) == sorted(tables["clustered"].read().collect())
    counts = {}
    for name, table in tables.items():
        day = {"order_date": wanted.order_date}
        counts[name] = [groups_to_read(table.root, **day, **more) for more in ({}, {"customer_id": wanted.customer_id}, {"product_id": wanted.product_id})]
    (plain_day, total), *_ = counts["plain"]
    (day, parts), (customer, _), (product, _) = counts["clustered"]
    assert parts > 60 and plain_day > total / 2 - 1
    assert day < parts / 4 and customer <= day / 1.3 and product <= day / 1.3
    frame = tables["clustered"].read().where(F.col("order_date").eqNullSafe(wanted.order_date) & (F.col("customer_id") == wanted.customer_id))
    scan = frame._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(customer_id" in scan and "EqualNullSafe(order_date" in scan


def test_range_numbers_cut_keys_evenly(spark, orders):
    number = clustering.curve(orders, ("customer_id",), bits=3)
    sizes = [r["count"] for r in orders.groupBy(number.alias("k")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.2 * min(sizes)
    spread = orders.groupBy(number.alias("k")).agg(F.min("customer_id").alias("a"), F.max("customer_id").alias("b")).orderBy("k").collect()
    assert all(x.b < y.a for x, y in zip(spread, spread[1:]))


def test_keys_that_are_equal_null_or_missing(spark):
    rows = spark.createDataFrame([("é", None), ("é", None), (None, None)], "a string, b string")
    place = clustering.curve(rows, ("a", "b"))
    assert clustering.clustered(rows, ("a",), place).count() == 3
    assert clustering.clustered(rows.limit(0), ("a",), clustering.curve(rows.limit(0), ("a", "b"))).count() == 0
