"""Every operator as a named query ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.catalog.layers import AS_OF, Layers
from tillstar.functions import calendar, keys
from tillstar.operators import contracts, dedup, history, integrity
from tillstar.plans import (
    customer_history,
    customers,
    dashboard,
    dates,
    declared_tests,
    orders_etl,
    products,
    quality_gate,
    sales,
    staging,
    verification,
)
from tillstar.schemas import LOADED_ORDERS, ORDER_STATUSES, RAW_COLUMNS, TYPED_FEED
from tillstar.sources import bulk_load, file_loads, manifest, snapshots, synthetic_feed, workspace
from tillstar.sources.commits import CommittedTable

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}

# Clock columns differ on every run.
CLOCKS = ("etl_loaded_at", "dbt_updated_at")
HISTORY_RUNS = [dt.date(1998, 12, 31), dt.date(2000, 6, 30), AS_OF]


def query(build: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    _registry[build.__name__] = lambda spark, sf_dir: build(Layers(spark, sf_dir)).drop(*CLOCKS)
    return build


def registered() -> dict[str, Query]:
    return dict(_registry)


# --- order ETL -------------------------------------------------------------------------------------


@query
def raw_feed(layers):
    return layers.raw()


@query
def csv_feed_scan(layers):
    return layers.feed()


@query
def typed_orders(layers):
    return orders_etl.typed_orders(layers.feed())


@query
def valid_orders(layers):
    return typed_orders(layers).transform(orders_etl.valid_orders)


@query
def normalised_orders(layers):
    return valid_orders(layers).transform(orders_etl.normalised_orders)


@query
def deduped_orders(layers):
    return normalised_orders(layers).transform(orders_etl.deduped_orders)


@query
def staged_orders(layers):
    return orders_etl.staged_orders(layers.feed())


@query
def etl_funnel(layers):
    return orders_etl.etl_funnel(layers.feed())


@query
def staged_roundtrip(layers):
    return layers.staged()


@query
def noisy_feed(layers):
    identity = F.concat_ws("|", *RAW_COLUMNS)
    return synthetic_feed.with_noise(layers.feed(), identity)


# --- loads -----------------------------------------------------------------------------------------


@query
def copy_into_good(layers):
    return bulk_load.accepted_rows(bulk_load.classify(layers.feed(), TYPED_FEED), TYPED_FEED)


@query
def copy_into_errors(layers):
    return bulk_load.rejected_rows(bulk_load.classify(layers.feed(), TYPED_FEED))


@query
def copy_into_counts(layers):
    done = bulk_load.copy_into(layers.feed(), TYPED_FEED, "orders_copy")
    outcome = F.when(F.col(bulk_load.OUTCOME) == bulk_load.LOADED, "rows_loaded").otherwise("rows_errors")
    return done.table.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("row_count"))


@query
def copy_into_strict(layers):
    return bulk_load.copy_into(layers.staged(), LOADED_ORDERS, "orders_strict", on_error="abort").loaded


def _planted_files(layers) -> CommittedTable:
    """Staged orders as Parquet with bad values and missing keys, in two deliveries, each loaded as it arrives, then loaded again."""
    source = workspace.new_location(layers.spark, "planted_orders")
    kind = F.substring("order_id", 2, 8).cast("int") % 50
    planted = layers.staged().drop("etl_loaded_at").withColumns(
        {
            "quantity": F.when(kind == 1, "x").when(kind == 2, "2.5").otherwise(F.col("quantity").cast("string")),
            "order_date": F.when(kind == 3, "2024-02-30").otherwise(F.col("order_date").cast("string")),
            "customer_id": F.when(kind != 4, F.col("customer_id")),
        }
    )
    table = CommittedTable(layers.spark, workspace.new_location(layers.spark, "orders_from_files"))
    for delivery in (kind < 25, kind >= 25):
        planted.where(delivery).write.parquet(source, mode="append", partitionBy=["year", "month"])
        file_loads.load_files(layers.spark, source, LOADED_ORDERS, table)
    file_loads.load_files(layers.spark, source, LOADED_ORDERS, table)
    return table


@query
def load_files_good(layers):
    return file_loads.loaded_rows(_planted_files(layers), LOADED_ORDERS)


@query
def load_files_errors(layers):
    return file_loads.rejected_rows(_planted_files(layers)).select("order_id", "customer_id", "quantity", "order_date", "year", "month", "load_reason")


@query
def snapshot_replace_verify(layers):
    snapshots.replace_snapshot(layers.staged(), "tillstar_orders_snapshot", "order_id", ("year", "month"))
    found = snapshots.key_check(layers.spark.table("tillstar_orders_snapshot"), "order_id", "etl_loaded_at")
    return found.select("total_orders", "unique_orders", F.col("latest_load").isNotNull().alias("has_load_time"))


@query
def warehouse_table(layers):
    """The staged set as a catalog table laid out by month."""
    snapshots.save_table(layers.staged(), "tillstar_orders_table", ("year", "month"))
    return layers.spark.table("tillstar_orders_table")


@query
def staging_view(layers):
    """The staging view over the staged set; it finds the newest commit on every read."""
    staged = CommittedTable(layers.spark, layers.staged_location())
    snapshots.save_view(layers.spark, staging.statement(f"({staged.statement()})"), "tillstar_stg_orders")
    return layers.spark.table("tillstar_stg_orders")


@query
def load_check(layers):
    checked = snapshots.load_check(layers.staged(), "etl_loaded_at")
    return checked.select("row_count", F.col("latest_load").isNotNull().alias("has_load_time"))


@query
def load_stamps(layers):
    """Load times of staged months: every order has the one of its job, and none lies ahead."""
    stamp = F.col("etl_loaded_at")
    return layers.staged().groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count(stamp).alias("stamped"),
        (F.min(stamp) == F.max(stamp)).alias("one_moment"),
        (F.max(stamp) <= calendar.load_time()).alias("in_the_past"),
    )


@query
def legal_names(layers):
    """Which values of the feed could name a table."""
    words = F.explode(F.array("category", "status", "country", "store_id", "channel", F.concat_ws(".", "country", "channel")))
    names = layers.feed().select(words.alias("name")).where("name IS NOT NULL").distinct()
    return names.select("name", keys.is_legal_name(F.col("name")).alias("legal"))


@query
def load_verification(layers):
    return verification.load_verification(layers.staged())


@query
def load_profile(layers):
    return verification.load_profile(layers.staged())


@query
def source_manifest(layers):
    listing = manifest.require_objects(layers.spark, layers.sf_dir, "*.parquet")
    return listing.select(F.substring_index("path", "/", -1).alias("object"), "size_bytes", "modified_at")


@query
def layer_metrics(layers):
    return manifest.layer_metrics(layers.spark, {"raw": layers.feed_location(), "staging": layers.staged_location()})


# --- star schema -----------------------------------------------------------------------------------


@query
def stg_orders(layers):
    return layers.stg()


@query
def dim_date(layers):
    return dates.dim_date(dates.years_covering(layers.stg(), "order_date"), AS_OF)


@query
def dim_date_fixed(layers):
    """The calendar of 1,096 days, with the orders of each day."""
    days = dates.dim_date(dates.date_span(layers.spark, dt.date(1998, 1, 1)), AS_OF)
    orders = layers.stg().groupBy(F.col("order_date").alias("full_date")).agg(F.count("order_id").alias("orders"))
    return days.join(orders, "full_date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query
def dim_customers(layers):
    return customers.dim_customers(layers.stg(), AS_OF)


@query
def dim_products(layers):
    return products.dim_products(layers.stg())


@query
def fct_sales(layers):
    return sales.fct_sales(layers.stg(), layers.customer_segments())


@query
def customer_country_mode(layers):
    return customers.customer_country_mode(layers.stg())


@query
def product_category_mode(layers):
    return products.product_category_mode(layers.stg())


@query
def customer_rfm(layers):
    return layers.dim_customers().select("customer_id", "total_orders", "total_spend", "customer_segment")


@query
def customer_churn(layers):
    return layers.dim_customers().select("customer_id", "days_since_last_order", "churn_risk")


@query
def product_revenue_tier(layers):
    revenue = products.product_revenue(layers.stg())
    tier = products.rank_tier(revenue, "total_revenue", products.TIERS, products.LOWEST_TIER)
    return revenue.select("product_id", "total_revenue", tier.alias("revenue_tier"))


@query
def product_return_rate(layers):
    return (
        layers.stg()
        .groupBy("product_id")
        .agg(F.count_if(F.col("order_status") == "returned").alias("return_count"), F.count("order_id").alias("total_orders"))
        .withColumn("return_rate_pct", products.return_rate(F.col("return_count"), F.col("total_orders")))
    )


# --- dashboards ------------------------------------------------------------------------------------


@query
def revenue_trend_daily(layers):
    return dashboard.revenue_trend_daily(layers.fct_sales(), layers.dim_date())


@query
def revenue_trend_monthly(layers):
    return dashboard.revenue_trend_monthly(layers.fct_sales(), layers.dim_date())


@query
def revenue_by_category(layers):
    return dashboard.revenue_by_category(layers.fct_sales(), layers.dim_products())


@query
def segment_mix(layers):
    return dashboard.segment_mix(layers.dim_customers())


@query
def top_countries(layers):
    return dashboard.top_countries(layers.fct_sales(), layers.dim_customers())


@query
def channel_performance(layers):
    return dashboard.channel_performance(layers.fct_sales())


@query
def churn_summary(layers):
    return dashboard.churn_summary(layers.dim_customers(), AS_OF)


# --- contracts -------------------------------------------------------------------------------------


@query
def quality_gate_report(layers):
    return quality_gate.quality_report(layers.staged())


@query
def quality_gate_verdict(layers):
    return contracts.verdict(quality_gate.quality_report(layers.staged()))


@query
def quality_gate_of_nothing(layers):
    """The gate over staged orders none of which is of the year that is asked for."""
    return quality_gate.quality_report(layers.staged().where("year < 0"))


@query
def duplicate_order_ids(layers):
    return dedup.duplicate_keys(layers.feed(), "order_id")


@query
def not_null_test(layers):
    return integrity.not_null(layers.feed(), "order_id")


@query
def unique_test(layers):
    return integrity.unique(layers.feed(), "order_id")


@query
def accepted_values_test(layers):
    return integrity.accepted_values(layers.feed(), "status", ORDER_STATUSES)


@query
def expression_test(layers):
    return integrity.expression_is_true(layers.stg(), "gross_amount", ">= 1000", where="discount_pct > 0")


@query
def relationships_test(layers):
    """Feed rows whose order was not staged."""
    return integrity.relationships(layers.feed(), "order_id", layers.staged(), "order_id")


@query
def orphan_keys_test(layers):
    return integrity.orphan_keys(layers.feed(), "order_id", layers.staged(), "order_id")


@query
def freshness(layers):
    noon = dt.datetime.combine(AS_OF, dt.time(12))
    return integrity.freshness(layers.staged(), "order_date", as_of=noon)


@query
def declared_tests_report(layers):
    return declared_tests.declared_report(layers.tables())


# --- history ---------------------------------------------------------------------------------------


def _history(layers, keep) -> DataFrame:
    table = CommittedTable(layers.spark, workspace.new_location(layers.spark, "customer_history"))
    for day in HISTORY_RUNS:
        until = layers.stg().where(F.col("order_date") <= F.lit(day))
        customer_history.record_run(table, keep(customers.dim_customers(until, day)), dt.datetime.combine(day, dt.time()))
    return table.read().withColumnRenamed(history.UPDATED_AT, "version_updated_at")


@query
def customers_scd2(layers):
    """Customer history over three runs, each on all orders up to its day."""
    return _history(layers, lambda dim: dim)


@query
def active_customers_scd2(layers):
    """The same runs over active customers: keys leave the input and come back."""
    return _history(layers, customer_history.active)
