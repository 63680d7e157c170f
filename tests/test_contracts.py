from __future__ import annotations

import datetime as dt

import pytest
from conftest import by
from pyspark.sql import functions as F

from tillstar.operators import contracts, integrity
from tillstar.plans import customers, dates, declared_tests, orders_etl, products, quality_gate, sales, staging

VOLUME = (1, 100)
ANY_SHARE = (0.0, 1.0)
NAMES = {
    "order_id": "order_id: no nulls",
    "unit_price": "unit_price: positive and bounded",
    "quantity": "quantity: valid range 1–100",
    "net_amount": "net_amount: always positive",
    "status": "status: accepted values only",
    "category": "category: at least 95% populated",
    "customer_format": "customer_id: format C######",
    "product_format": "product_id: format P#####",
}


@pytest.fixture(scope="module")
def staged(spark, raw):
    rows = orders_etl.staged_orders(raw(*[{"order_id": f"O{i}", "customer_id": f"C{i:06d}"} for i in range(20)]))
    return spark.createDataFrame(rows.collect(), rows.schema).coalesce(2)


def report(frame, volume=VOLUME, cardinality=ANY_SHARE):
    return quality_gate.quality_report(frame, volume, cardinality)


def spoil(frame, column, value, rows=1):
    hit = F.col("order_id").isin([f"O{i}" for i in range(rows)])
    return frame.withColumn(column, F.when(hit, F.lit(value)).otherwise(F.col(column)).cast(frame.schema[column].dataType))


def test_clean_data_passes_all_sixteen_checks(staged):
    lines = report(staged).collect()
    assert len(lines) == 16 and all(line.success for line in lines)
    assert quality_gate.gate_passes(report(staged))


@pytest.mark.parametrize(
    ("column", "value", "check"),
    [
        ("unit_price", 0.009, "unit_price"), ("unit_price", 10000.01, "unit_price"), ("unit_price", None, "unit_price"),
        ("quantity", 0, "quantity"), ("quantity", 101, "quantity"), ("quantity", None, "quantity"),
        ("net_amount", 0.0, "net_amount"), ("net_amount", None, "net_amount"),
        ("status", "lost", "status"), ("status", None, "status"),
        ("order_id", None, "order_id"),
    ],
)
def test_critical_violation_closes_the_gate(staged, column, value, check):
    lines = by(report(spoil(staged, column, value)), "name")
    line = lines[NAMES[check]]
    assert (line.success, line.severity, line.invalid_count, line.unexpected_percent) == (False, "critical", 1, 5.0)
    assert not quality_gate.gate_passes(report(spoil(staged, column, value)))


@pytest.mark.parametrize(("column", "value", "check"), [("unit_price", 0.01, "unit_price"), ("unit_price", 10000.0, "unit_price"),
                                                        ("quantity", 100, "quantity"), ("net_amount", 0.01, "net_amount")])
def test_bounds_are_inclusive(staged, column, value, check):
    assert by(report(spoil(staged, column, value)), "name")[NAMES[check]].success


@pytest.mark.parametrize(("column", "value", "check"), [("customer_id", "C12345", "customer_format"), ("customer_id", "xC123456", "customer_format"),
                                                        ("product_id", "P1234567", "product_format")])
def test_format_violation_only_warns(staged, column, value, check):
    spoiled = report(spoil(staged, column, value))
    assert not by(spoiled, "name")[NAMES[check]].success
    verdict = contracts.verdict(spoiled).first()
    assert (verdict.cleared, verdict.passed, verdict.warnings, verdict.critical_failures) == (True, 15, NAMES[check], "")


@pytest.mark.parametrize(("value", "rows", "ok"), [(None, 1, True), (" ", 1, True), (None, 2, False), ("", 2, False)])
def test_category_completeness(staged, value, rows, ok):
    line = by(report(spoil(staged, "category", value, rows)), "name")[NAMES["category"]]
    assert (line.success, line.invalid_count, line.severity) == (ok, rows, "warning")


def test_duplicates_are_counted_per_key(staged):
    tripled = staged.unionByName(staged.where("order_id in ('O1', 'O2')")).unionByName(staged.where("order_id = 'O1'"))
    line = by(report(tripled), "name")[quality_gate.UNIQUE_NAME]
    assert (line.success, line.invalid_count, line.unexpected_percent) == (False, 2, 2 / 23 * 100)


@pytest.mark.parametrize(("bounds", "ok"), [((20, 20), True), ((21, 30), False), ((1, 19), False)])
def test_volume(staged, bounds, ok):
    line = by(report(staged, bounds), "name")[quality_gate.VOLUME_NAME]
    assert (line.success, line.invalid_count, line.unexpected_percent) == ((True, 0, 0.0) if ok else (False, 20, 100.0))


def test_cardinality_out_of_range_warns(staged):
    line = by(report(staged, cardinality=(0.01, 0.2)), "name")[quality_gate.CARDINALITY_NAME]
    assert (line.success, line.severity, line.invalid_count) == (False, "warning", 20)


def test_missing_column_stops_the_gate(staged):
    lines = report(staged.drop("payment", "country")).collect()
    assert [(line.name, line.success, line.invalid_count) for line in lines] == [(quality_gate.SCHEMA_NAME, False, 2)]
    assert not quality_gate.gate_passes(report(staged.drop("payment")))


def test_empty_data_fails(staged):
    assert not quality_gate.gate_passes(report(staged.where(F.lit(False)), volume=(0, 10)))


# --- declarative tests -----------------------------------------------------------------------------


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, None), (None, 3, "y"), (None, None, "z"), ("b", -4, "x")], "k string, n int, v string"
    )


def test_not_null(table):
    assert integrity.not_null(table, "k").count() == 2


def test_unique_ignores_nulls(table):
    assert [tuple(r) for r in integrity.unique(table, "k").collect()] == [("a", 2)]


def test_accepted_values_lets_null_pass(table):
    assert [r.v for r in integrity.accepted_values(table, "v", ["x", "y"]).collect()] == ["z"]


def test_expression_fails_only_when_false(table):
    assert [r.n for r in integrity.expression_is_true(table, "n", "> 1").orderBy("n").collect()] == [-4, 1]
    assert [r.n for r in integrity.expression_is_true(table, "n", "> 1", where="k = 'a'").collect()] == [1]


def test_relationships_and_orphan_keys(spark, table):
    parent = spark.createDataFrame([("b",), ("c",)], "id string")
    assert [r.n for r in integrity.relationships(table, "k", parent, "id").orderBy("n").collect()] == [1, 2]
    assert [tuple(r) for r in integrity.orphan_keys(table, "k", parent, "id").collect()] == [("a", 2)]


@pytest.mark.parametrize(("hours", "status"), [(0, "pass"), (24, "pass"), (25, "warn"), (48, "warn"), (49, "error")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2024, 5, 10, 12)
    loads = spark.createDataFrame([(now - dt.timedelta(hours=hours),), (now - dt.timedelta(days=9),)], "t timestamp_ntz")
    row = integrity.freshness(loads, "t", as_of=now).first()
    assert (row.status, row.age_hours, row.newest_load) == (status, hours, now - dt.timedelta(hours=hours))


def test_freshness_without_any_load(spark):
    loads = spark.createDataFrame([], "t timestamp_ntz")
    assert integrity.freshness(loads, "t").first().status == "error"


# --- the declared suite ----------------------------------------------------------------------------


@pytest.fixture
def tables(staged):
    day = dt.date(2024, 7, 1)
    stg = staging.stg_orders(staged)
    dim = customers.dim_customers(stg, day)
    return {
        "raw_orders": staged,
        "fct_sales": sales.fct_sales(stg, dim),
        "dim_customers": dim,
        "dim_products": products.dim_products(stg),
        "dim_date": dates.dim_date(dates.years_covering(stg, "order_date"), day),
    }


def test_forty_six_declared_tests_pass_on_clean_data(tables):
    lines = declared_tests.declared_report(tables).collect()
    assert len(lines) == 46
    assert {(line.status, line.failures) for line in lines} == {("pass", 0)}
    sizes = {t: sum(line.table_name == t for line in lines) for t in tables}
    assert sizes == {"raw_orders": 11, "fct_sales": 16, "dim_customers": 8, "dim_products": 6, "dim_date": 5}


def test_declared_tests_see_each_kind_of_damage(tables):
    tables["dim_customers"] = tables["dim_customers"].where("customer_id <> 'C000003'")
    tables["fct_sales"] = tables["fct_sales"].unionByName(tables["fct_sales"].where("customer_id = 'C000004'")).withColumn(
        "gross_amount", F.when(F.col("customer_id") == "C000005", 0.0).otherwise(F.col("gross_amount"))
    )
    failed = {
        (line.table_name, line.column_name, line.test): (line.status, line.failures)
        for line in declared_tests.declared_report(tables).collect()
        if line.failures
    }
    assert failed == {
        ("raw_orders", "customer_id", "relationships"): ("warn", 1),
        ("fct_sales", "customer_id", "relationships"): ("error", 1),
        ("fct_sales", "sale_key", "unique"): ("error", 1),
        ("fct_sales", "order_id", "unique"): ("error", 1),
        ("fct_sales", "gross_amount", "expression_is_true"): ("error", 1),
    }
