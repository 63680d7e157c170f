"""The layered tables behind the queries, written once per session and input folder.

Staged orders and the star schema are tables in a real deployment, so the queries read them as tables:
a mart or dashboard query scans a few columns of written Parquet and never repeats the order ETL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillstar.catalog.driver_feed import raw_orders
from tillstar.plans import customers, dates, orders_etl, products, sales, staging
from tillstar.sources import workspace
from tillstar.sources.orders_feed import read_feed, write_feed
from tillstar.sources.staging_area import read_staged, write_staged

# The driver tables end in 2001, so reports are dated then.
AS_OF = dt.date(2001, 10, 1)

_written: dict[tuple[str, str, str], str] = {}


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def _location(self, layer: str, write: Callable[[str], object]) -> str:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, layer)
        if key not in _written:
            location = workspace.new_location(self.spark, layer)
            write(location)
            _written[key] = location
        return _written[key]

    def _table(self, layer: str, build: Callable[[], DataFrame], partition_by: tuple[str, ...] = (), shuffle: bool = True) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, layer)
        if key not in _written:
            _written[key] = workspace.write_once(build(), layer, partition_by, shuffle)
        return self.spark.read.parquet(_written[key])

    def raw(self) -> DataFrame:
        """The feed as derived from the driver tables."""
        return raw_orders(self.spark, self.sf_dir)

    def feed_location(self) -> str:
        return self._location("raw_feed", lambda path: write_feed(self.raw(), path, packed=True))

    def feed(self) -> DataFrame:
        """The feed as CSV files, the form in which orders arrive and the ETL reads them.

        The ETL must see plain columns: Catalyst pushes its filters below the typing and would copy the
        whole derivation of each column into every predicate.
        """
        return read_feed(self.spark, self.feed_location())

    def staged_location(self) -> str:
        return self._location("staged_orders", lambda path: write_staged(orders_etl.staged_by_month(self.feed()), path, arrange=False))

    def staged(self) -> DataFrame:
        return read_staged(self.spark, self.staged_location())

    def stg(self) -> DataFrame:
        return staging.stg_orders(self.staged())

    def dim_customers(self) -> DataFrame:
        return self._table("dim_customers", lambda: customers.dim_customers(self.stg(), AS_OF))

    def customer_segments(self) -> DataFrame:
        """The two columns that the fact takes from the customers, a table of its own: Spark judges a join by the size of whole files."""
        return self._table("customer_segments", lambda: self.dim_customers().select("customer_id", "customer_segment"))

    def dim_products(self) -> DataFrame:
        return self._table("dim_products", lambda: products.dim_products(self.stg()))

    def dim_date(self) -> DataFrame:
        return self._table("dim_date", lambda: dates.dim_date(dates.years_covering(self.stg(), "order_date"), AS_OF))

    def fct_sales(self) -> DataFrame:
        return self._table("fct_sales", lambda: sales.fct_sales(self.stg(), self.customer_segments(), together=True), sales.LAYOUT, shuffle=False)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "raw_orders": self.staged(),
            "fct_sales": self.fct_sales(),
            "dim_customers": self.dim_customers(),
            "dim_products": self.dim_products(),
            "dim_date": self.dim_date(),
        }
