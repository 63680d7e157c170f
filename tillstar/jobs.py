"""The pipeline as jobs, each reading and writing tables, so any of them can be rerun on its own."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, Row, SparkSession

from tillstar.functions.calendar import load_time
from tillstar.functions.keys import layer_name
from tillstar.operators import integrity
from tillstar.operators.contracts import CRITICAL
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
from tillstar.plans.orders_etl import EtlSummary
from tillstar.schemas import LOADED_ORDERS
from tillstar.sources import bulk_load, file_loads, manifest, monthly, snapshots, synthetic_feed
from tillstar.sources.commits import CommittedTable
from tillstar.sources.file_loads import FileLoad
from tillstar.sources.orders_feed import read_feed, write_feed
from tillstar.sources.staging_area import LAYOUT, read_staged


class GateClosed(RuntimeError):
    """A critical check failed; nothing downstream may run."""


class LayerRejected(RuntimeError):
    """A table failed a declared test of severity error; it was not published."""


def generate(spark: SparkSession, feed: str, rows: int = 1_000_000, seed: int = 42) -> None:
    """A synthetic feed with noise as CSV files."""
    write_feed(synthetic_feed.noisy_feed(spark, rows, seed), feed)


def stage(spark: SparkSession, feed: str, staged: str, months: Collection[tuple[int, int]] | None = None) -> EtlSummary:
    """Raw CSV to staged Parquet, whole or some months of it. An absent or empty feed fails before any work is done."""
    manifest.require_objects(spark, feed)
    return orders_etl.run_etl(read_feed(spark, feed), staged, months)


def check(spark: SparkSession, staged: str, **bounds) -> list[Row]:
    """The sixteen report lines, evaluated once; raises when a critical one failed."""
    lines = quality_gate.quality_report(read_staged(spark, staged), **bounds).collect()
    failed = [line["name"] for line in lines if line["severity"] == CRITICAL and not line["success"]]
    if failed:
        raise GateClosed(f"{staged}: {', '.join(failed)}")
    return lines


def load(spark: SparkSession, staged: str, target: str = "orders") -> snapshots.Snapshot:
    """Strict load of the staged set into the published orders; of a set that was committed, only months that differ."""

    def typed(rows: DataFrame) -> DataFrame:
        return bulk_load.strict(rows, LOADED_ORDERS).withColumn("etl_loaded_at", load_time())

    source = CommittedTable(spark, staged)
    if source.numbers():
        return snapshots.follow_snapshot(source, target, "order_id", typed, LAYOUT, "etl_loaded_at")[0]
    return snapshots.replace_snapshot(typed(read_staged(spark, staged)), target, "order_id", LAYOUT, "etl_loaded_at")


def load_tolerant(spark: SparkSession, staged: str, target: str = "loaded_files") -> FileLoad:
    """Append the files that were not loaded yet, rejected rows aside; the counts are those of this load."""
    return file_loads.load_files(spark, staged, LOADED_ORDERS, snapshots.table(spark, target))


def verify(spark: SparkSession, target: str = "orders", as_of: dt.datetime | None = None) -> tuple[Row, Row]:
    """Figures of the published orders, and how old their newest load is."""
    orders = snapshots.published(spark, target)
    return verification.load_verification(orders).first(), integrity.freshness(orders, "etl_loaded_at", as_of=as_of).first()


def mart_name(table: str, schema: str | None = None) -> str:
    """Marts live in the session's schema unless a custom one is named."""
    return table if schema is None else f"{layer_name(schema, '')}.{table}"


def _tested(table: str) -> Callable[[DataFrame], dict[str, str]]:
    """A check for a write: the table's own declared tests, of which those of severity error must hold."""

    def check(rows: DataFrame) -> dict[str, str]:
        failed = declared_tests.own_report(table, rows).where("status = 'error'").collect()
        if failed:
            raise LayerRejected(f"{table}: " + ", ".join(f"{line['test']} of {line['column_name']} ({line['failures']})" for line in failed))
        return {}

    return check


def _states(spark: SparkSession, orders: str, schema: str | None) -> dict[str, DataFrame]:
    """Partial sums by month behind the dimensions, brought up to the orders: only months that differ are read."""
    source = snapshots.table(spark, orders)
    commit = source.latest()
    builders = {"customer_state": customers.customer_partials, "product_state": products.product_partials, "buyer_state": products.product_buyers}
    if commit.layout != LAYOUT:
        stg = staging.stg_orders(source.read(commit))
        return {name: build(stg) for name, build in builders.items()}
    out = {}
    for name, build in builders.items():
        # Per target, so that marts of several order tables don't mix.
        held = snapshots.table(spark, mart_name(f"{name}_of_{orders.replace('.', '_')}", schema))
        done, _ = monthly.follow(source, held, lambda rows, b=build: b(staging.stg_orders(rows), *sales.LAYOUT), sales.LAYOUT, commit)
        out[name] = held.read(done)
    return out


def build_marts(spark: SparkSession, orders: str = "orders", schema: str | None = None, as_of: dt.date | None = None) -> None:
    """Dimensions first, then the fact on the written customer dimension. The orders are tested before, every mart before it is visible."""
    # The view follows the orders; the marts of a run all come from one version of them.
    source = snapshots.published(spark, orders)
    _tested("raw_orders")(source)
    stg = staging.stg_orders(source)
    snapshots.save_view(spark, staging.statement(f"({snapshots.table(spark, orders).statement()})"), "stg_orders")
    states = _states(spark, orders, schema)

    def save(name: str, rows: DataFrame, cluster_by: tuple[str, ...] = (), arranged: bool = False) -> None:
        snapshots.save_table(rows, mart_name(name, schema), cluster_by, _tested(name), arranged)

    save("dim_customers", customers.customers_from(states["customer_state"], as_of))
    save("dim_products", products.products_from(states["product_state"], states["buyer_state"]))
    save("dim_date", dates.dim_date(dates.years_covering(stg, "order_date"), as_of))
    written = snapshots.published(spark, mart_name("dim_customers", schema))
    save("fct_sales", sales.arranged(sales.fct_sales(stg, written), stg), sales.LAYOUT, arranged=True)


def marts(spark: SparkSession, orders: str = "orders", schema: str | None = None) -> dict[str, DataFrame]:
    names = ("fct_sales", "dim_customers", "dim_products", "dim_date")
    return {"raw_orders": snapshots.published(spark, orders), **{n: snapshots.published(spark, mart_name(n, schema)) for n in names}}


def run_declared_tests(spark: SparkSession, orders: str = "orders", schema: str | None = None) -> DataFrame:
    return declared_tests.declared_report(marts(spark, orders, schema))


def reports(tables: dict[str, DataFrame], as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """The dashboard's six questions, plus the trend by month, whole."""
    fact, dim = tables["fct_sales"], tables["dim_customers"]
    return {
        "revenue_trend_daily": dashboard.revenue_trend_daily(fact, tables["dim_date"]),
        "revenue_trend_monthly": dashboard.revenue_trend_monthly(fact, tables["dim_date"]),
        "revenue_by_category": dashboard.revenue_by_category(fact, tables["dim_products"]),
        "segment_mix": dashboard.segment_mix(dim),
        "top_countries": dashboard.top_countries(fact, dim),
        "channel_performance": dashboard.channel_performance(fact),
        "churn_summary": dashboard.churn_summary(dim, as_of),
    }


def publish_reports(spark: SparkSession, orders: str = "orders", schema: str | None = None, as_of: dt.date | None = None) -> dict[str, str]:
    """Every report as a published table; returns where each one is."""
    made = reports(marts(spark, orders, schema), as_of)
    return {name: snapshots.save_table(report, mart_name(f"report_{name}", schema)) for name, report in made.items()}


def record_history(spark: SparkSession, run_at: dt.datetime, schema: str | None = None) -> int:
    """Continue the published customer history, or begin it; returns its number of versions."""
    target = mart_name("customer_history", schema)
    current = snapshots.published(spark, mart_name("dim_customers", schema))
    done = customer_history.record_run(snapshots.table(spark, target), current, run_at)
    snapshots.show(spark, target)
    return done.rows
