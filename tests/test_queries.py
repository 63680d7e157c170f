"""Every registered query against its SQL, the SQL against the plain formulas, and the shape of the plans."""

from __future__ import annotations

import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tillstar.catalog import oracle
from tillstar.catalog.layers import Layers
from tillstar.catalog.queries import registered

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = registered(), oracle.statements()
LISTINGS = {"source_manifest", "layer_metrics"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not on this machine")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def comparable(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_only_listings_lack_sql():
    assert set(QUERIES) - set(ORACLE) == LISTINGS and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    names = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(names)
    assert comparable(frame.collect(), frame.columns) == comparable(result.fetchall(), names)


@pytest.mark.parametrize("name", sorted(LISTINGS))
def test_listings_have_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["channel", "orders", "revenue", "average_order_value", "avg_ship_days"]


# The exact forms used in the SQL against the formulas a report author would write.
PLAIN = {
    ("cust", "avg_order_value", 0.0051): "SELECT customer_id k, avg(net_amount) v FROM stg WHERE order_status <> 'cancelled' GROUP BY 1",
    ("cust", "total_spend", 0.0001): "SELECT customer_id k, sum(net_amount) v FROM stg WHERE order_status <> 'cancelled' GROUP BY 1",
    ("prod", "avg_selling_price", 0.0051): "SELECT product_id k, avg(unit_price) v FROM stg GROUP BY 1",
    ("prod", "avg_discount_pct", 0.051): "SELECT product_id k, avg(discount_pct) v FROM stg GROUP BY 1",
    ("prod", "return_rate_pct", 0.0051):
        "SELECT product_id k, 100.0 * count(*) FILTER (WHERE order_status = 'returned') / count(*) v FROM stg GROUP BY 1",
}


@pytest.mark.parametrize("target", sorted(PLAIN))
def test_exact_forms_agree_with_plain_formulas(duck, target):
    table, column, tolerance = target
    key = {"cust": "customer_id", "prod": "product_id"}[table]
    worst, n = duck.execute(oracle._on(
        table, f"SELECT max(abs(t.{column} - p.v)), count(*) FROM {table} t JOIN ({PLAIN[target]}) p ON t.{key} = p.k"
    )).fetchone()
    assert n > 0 and worst <= tolerance


def test_exact_figures_agree_with_plain_formulas(duck):
    got = duck.execute(f"SELECT avg_order_value, total_revenue_m FROM ({ORACLE['load_verification']})").fetchone()
    plain = duck.execute(oracle._on("staged", "SELECT avg(net_amount), sum(net_amount) / 1e6 FROM staged")).fetchone()
    assert got == pytest.approx(plain, abs=0.0051)
    channel = duck.execute(f"SELECT channel, average_order_value, avg_ship_days FROM ({ORACLE['channel_performance']}) ORDER BY 1").fetchall()
    plain = duck.execute(oracle._on("fct", "SELECT sales_channel, avg(net_amount), avg(days_to_ship) FROM fct GROUP BY 1 ORDER BY 1")).fetchall()
    for exact, rough in zip(channel, plain):
        assert exact[0] == rough[0] and abs(exact[1] - rough[1]) <= 0.0051 and abs(exact[2] - rough[2]) <= 0.051


# --- plans -----------------------------------------------------------------------------------------


@pytest.fixture(autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_rows_leaves_the_jvm_or_ranks_in_one_task(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in text
    assert "Window" not in text or "windowspecdefinition(order_id" in text


def test_dedup_drops_copies_before_the_shuffle(spark):
    lines = plan(QUERIES["deduped_orders"](spark, SF_DIR)).splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(order_id" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[exchange:])
    assert sum("Exchange" in line for line in lines) == 1


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("channel_performance", {"order_id", "sales_channel", "net_amount", "days_to_ship"}),
        ("top_countries", {"order_id", "customer_id", "net_amount", "country_code"}),
        ("revenue_by_category", {"order_id", "product_id", "net_amount", "category"}),
        ("segment_mix", {"customer_segment"}),
    ],
)
def test_scans_read_only_what_the_report_needs(spark, name, columns):
    text = plan(QUERIES[name](spark, SF_DIR))
    read = {field.split(":")[0] for part in text.split("ReadSchema: struct<")[1:] for field in part.split(">")[0].split(",")}
    assert read <= columns


def test_filters_reach_the_parquet_scan(spark):
    stg = Layers(spark, SF_DIR).stg().where("order_date <= date'1999-01-01'")
    assert "LessThanOrEqual(order_date,1999-01-01)" in plan(stg)
    assert "GreaterThan(quantity,0)" in plan(stg)


def test_dates_of_the_runs_match_the_sql():
    from tillstar.catalog.layers import AS_OF
    from tillstar.catalog.queries import HISTORY_RUNS

    assert [d.isoformat() for d in HISTORY_RUNS] == oracle.RUNS and AS_OF == dt.date(2001, 10, 1)
