from __future__ import annotations

import datetime as dt
import hashlib
import random

import pytest
from conftest import by
from pyspark.sql import functions as F

from tillstar.functions import scoring
from tillstar.functions.keys import surrogate_key
from tillstar.operators.tiers import rank_tier
from tillstar.plans import customers, dates, orders_etl, products, sales, staging

TODAY = dt.date(2024, 7, 1)


def days_ago(n):
    return TODAY - dt.timedelta(days=n)


# --- staging ---------------------------------------------------------------------------------------


def test_staging_view_renames_defaults_and_filters(raw):
    staged = orders_etl.staged_orders(raw({"order_id": "A"}, {"order_id": "B"}))
    loaded = staged.withColumn("discount_pct", F.when(F.col("order_id") == "A", None).otherwise(F.col("discount_pct")))
    view = by(staging.stg_orders(loaded), "order_id")
    assert (view["A"].discount_pct, view["B"].discount_pct) == (0, 10)
    assert (view["A"].product_category, view["A"].sales_channel, view["A"].order_year) == ("Books", "online", 2024)
    for gap in ("customer_id", "order_date", "unit_price", "quantity"):
        assert staging.stg_orders(loaded.withColumn(gap, F.lit(None).cast(loaded.schema[gap].dataType))).count() == 0


# --- customers -------------------------------------------------------------------------------------


def test_customer_metrics_leave_cancelled_orders_out_but_country_counts_them(stg):
    rows = stg(
        {"net_amount": 10.0, "country_code": "IN", "product_category": "Books", "order_date": dt.date(2024, 1, 1)},
        {"net_amount": 5.25, "country_code": "US", "product_category": None, "order_date": dt.date(2024, 2, 1)},
        {"net_amount": 99.0, "country_code": "US", "order_status": "cancelled", "product_category": "Toys",
         "order_date": dt.date(2024, 6, 1)},
    )
    got = customers.dim_customers(rows, TODAY).first()
    assert (got.total_orders, got.total_spend, got.avg_order_value, got.distinct_categories) == (2, 15.25, 7.63, 1)
    assert (got.country_code, got.first_order_date, got.last_order_date) == ("US", dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    assert got.days_since_last_order == (TODAY - dt.date(2024, 2, 1)).days
    assert got.customer_key == hashlib.md5(b"C1").hexdigest()


def test_customer_with_only_cancelled_orders_is_absent_and_its_sales_are_unknown(stg):
    rows = stg({"customer_id": "C1"}, {"customer_id": "C2", "order_status": "cancelled"})
    dim = customers.dim_customers(rows, TODAY)
    assert [r.customer_id for r in dim.collect()] == ["C1"]
    extras = {c: F.lit(1) for c in ("order_year", "order_month", "order_quarter", "day_of_week")}
    wide = rows.withColumns({**extras, "is_weekend": F.lit(False), "etl_loaded_at": F.lit(None).cast("timestamp_ntz")})
    fact = by(sales.fct_sales(wide, dim), "customer_id")
    assert (fact["C1"].customer_segment, fact["C2"].customer_segment) == ("bronze", "unknown")


def test_customer_without_a_country(stg):
    assert customers.dim_customers(stg({"country_code": None}), TODAY).first().country_code is None


def test_country_tie_goes_to_the_smaller_code(stg):
    rows = stg({"country_code": "US"}, {"country_code": "DE"}, {"country_code": "US"}, {"country_code": "DE"}, {"country_code": None})
    assert customers.customer_country_mode(rows).first().country_code == "DE"


def test_mode_matches_brute_force(stg):
    rng = random.Random(3)
    rows = [{"customer_id": f"C{rng.choice([0, 0, 0, 1, 2, 3])}", "country_code": rng.choice(["A", "B", "C", None])} for _ in range(400)]
    got = {r.customer_id: r.country_code for r in customers.customer_country_mode(stg(*rows)).collect()}
    for customer in {r["customer_id"] for r in rows}:
        values = [r["country_code"] for r in rows if r["customer_id"] == customer and r["country_code"]]
        assert got[customer] == min(set(values), key=lambda v: (-values.count(v), v))


@pytest.mark.parametrize(
    ("spend", "orders", "segment"),
    [
        (10000.0, 20, "platinum"), (9999.99, 20, "gold"), (10000.0, 19, "gold"), (5000.0, 10, "gold"), (5000.0, 9, "silver"),
        (4999.99, 10, "silver"), (1000.0, 3, "silver"), (1000.0, 2, "bronze"), (999.99, 3, "bronze"), (50000.0, 2, "bronze"),
        (None, 2, "bronze"),
    ],
)
def test_segment_boundaries(spark, spend, orders, segment):
    frame = spark.createDataFrame([(spend, orders)], "s double, o bigint")
    assert frame.select(scoring.segment(F.col("s"), F.col("o"))).first()[0] == segment


@pytest.mark.parametrize(("days", "risk", "label"), [(0, "low", "Low Risk"), (90, "low", "Low Risk"), (91, "medium", "Medium Risk"),
                                                     (180, "medium", "Medium Risk"), (181, "high", "High Risk")])
def test_churn_boundaries(stg, days, risk, label):
    dim = customers.dim_customers(stg({"order_date": days_ago(days)}), TODAY)
    assert dim.first().churn_risk == risk
    assert dim.select(scoring.churn_label(F.col("last_order_date"), F.lit(TODAY))).first()[0] == label


def test_churn_label_without_any_order(spark):
    frame = spark.createDataFrame([(None,)], "d date")
    assert frame.select(scoring.churn_label(F.col("d"), F.lit(TODAY))).first()[0] == "High Risk"


def test_surrogate_key_is_md5_of_joined_text_with_a_null_marker(spark):
    frame = spark.createDataFrame([("a", 7), ("a", None)], "x string, y int").select(surrogate_key("x", "y"))
    expected = [hashlib.md5(t.encode()).hexdigest() for t in ("a-7", "a-_dbt_utils_surrogate_key_null_")]
    assert [r[0] for r in frame.collect()] == expected


# --- products --------------------------------------------------------------------------------------


def test_product_metrics(stg):
    rows = stg(
        {"net_amount": 10.0, "quantity": 2, "unit_price": 5.0, "discount_pct": 0, "customer_id": "C1"},
        {"net_amount": 4.5, "quantity": 1, "unit_price": 5.25, "discount_pct": 5, "customer_id": "C1", "order_status": "returned"},
        {"net_amount": 1.0, "quantity": 1, "unit_price": 5.0, "discount_pct": 20, "customer_id": "C2", "order_status": "cancelled",
         "product_category": "Toys"},
    )
    got = products.dim_products(rows).first()
    assert (got.total_orders, got.total_units_sold, got.total_revenue, got.return_count, got.unique_buyers) == (3, 4, 15.5, 1, 2)
    assert (got.avg_selling_price, got.avg_discount_pct, got.return_rate_pct) == (5.08, 8.3, 33.33)
    assert (got.category, got.revenue_tier) == ("Books", "top_100")


def test_product_without_a_category(stg):
    got = products.dim_products(stg({"product_category": None})).first()
    assert got.category is None and got.total_orders == 1


@pytest.mark.parametrize("rows", [1, 5, 40])
@pytest.mark.parametrize("seed", range(3))
def test_tiers_match_a_full_rank(spark, rows, seed):
    rng = random.Random(seed)
    values = [(i, rng.choice([None, 1, 2, 3, 5, 8, 13])) for i in range(rows)]
    frame = spark.createDataFrame(values, "id int, m bigint")
    tiers = [(3, "first"), (10, "second")]
    got = {r.id: r.tier for r in frame.select("id", rank_tier(frame, "m", tiers, "rest").alias("tier")).collect()}
    order = [float("inf") if v is None else v for _, v in values]
    for i, v in enumerate(order):
        rank = 1 + sum(w > v for w in order)
        assert got[i] == ("first" if rank <= 3 else "second" if rank <= 10 else "rest")


# --- dates -----------------------------------------------------------------------------------------


def test_default_calendar(spark):
    calendar = by(dates.dim_date(dates.date_span(spark), dt.date(2024, 3, 15)), "date_key")
    assert len(calendar) == 1096 and min(calendar) == 20230101 and max(calendar) == 20251231
    day = calendar[20241230]
    assert (day.week_of_year, day.year_of_week, day.day_of_week, day.day_of_year) == (1, 2025, 1, 365)
    assert (day.month_name, day.month_short, day.day_name, day.day_short, day.quarter_label) == ("December", "Dec", "Monday", "Mon", "Q4")
    sunday = calendar[20240107]
    assert (sunday.day_of_week, sunday.is_weekend) == (0, True)
    assert [calendar[k].is_past for k in (20240314, 20240315, 20240316)] == [True, True, False]
    assert (calendar[20240301].is_current_month, calendar[20230301].is_current_month) == (True, False)
    assert (calendar[20241231].is_current_year, calendar[20251231].is_current_year) == (True, False)


def test_calendar_covers_whole_years_of_the_data(stg):
    rows = stg({"order_date": dt.date(2019, 5, 5)}, {"order_date": dt.date(2020, 2, 2)})
    days = [r.full_date for r in dates.dim_date(dates.years_covering(rows, "order_date"), TODAY).collect()]
    assert (min(days), max(days), len(days)) == (dt.date(2019, 1, 1), dt.date(2020, 12, 31), 365 + 366)


# --- fact ------------------------------------------------------------------------------------------


def test_fact_flags_and_defaults(stg):
    rows = stg(
        {"order_id": "A", "order_status": "returned", "discount_pct": 5, "days_to_ship": 2, "discount_amount": None, "net_amount": None,
         "gross_amount": 12.5},
        {"order_id": "B", "days_to_ship": 3},
        {"order_id": "C", "days_to_ship": -1},
        {"order_id": "D", "days_to_ship": None, "order_status": None},
    )
    extras = {c: F.lit(1) for c in ("order_year", "order_month", "order_quarter", "day_of_week")}
    wide = rows.withColumns({**extras, "is_weekend": F.lit(False), "etl_loaded_at": F.lit(None).cast("timestamp_ntz")})
    fact = sales.fct_sales(wide, customers.dim_customers(rows, TODAY))
    assert fact.columns == sales.FACT_COLUMNS
    got = by(fact, "order_id")
    assert [got[k].is_fast_shipped for k in "ABCD"] == [True, False, True, False]
    assert [got[k].is_return for k in "ABCD"] == [True, False, False, False]
    assert [got[k].has_discount for k in "ABCD"] == [True, False, False, False]
    assert (got["A"].discount_amount, got["A"].net_amount, got["A"].date_key) == (0.0, 12.5, 20240101)


def test_orders_without_a_product_are_a_product_of_their_own(stg):
    rows = stg({"product_id": None, "customer_id": "C1"}, {"product_id": None, "customer_id": "C2"}, {"product_id": "P1"})
    found = by(products.dim_products(rows), "product_id")
    assert (found[None].total_orders, found[None].unique_buyers, found["P1"].total_orders) == (2, 2, 1)


def test_amounts_without_a_decimal_form_reach_the_dimensions(stg):
    rows = stg({"product_id": "P1", "net_amount": 1e40, "unit_price": 1e40}, {"product_id": "P1"}, {"product_id": "P2", "net_amount": float("nan")})
    found = by(products.dim_products(rows), "product_id")
    assert found["P1"].total_revenue == 1e40 and found["P1"].avg_selling_price == 5e39
    assert found["P2"].total_revenue != found["P2"].total_revenue
    assert customers.dim_customers(rows, TODAY).count() == 1
