from __future__ import annotations

import datetime as dt

import pytest

from tillstar.plans import dashboard, dates

D = dt.date


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame(
        [
            ("A", "C1", "P1", 20240101, "online", 10.05, 3),
            ("B", "C1", "P2", 20240101, "mobile", 20.10, None),
            ("C", "C2", "P1", 20240131, "online", 5.00, -4),
            ("D", "C3", "P9", 20240201, "online", 1.00, 0),
            ("E", "C9", "P2", 20300101, "mobile", 7.00, 5),
        ],
        "order_id string, customer_id string, product_id string, date_key int, sales_channel string, net_amount double, days_to_ship int",
    )


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [("C1", "IN", "gold", D(2024, 6, 1), 30.15), ("C2", "US", "gold", D(2024, 3, 1), 5.0), ("C3", None, "bronze", None, 1.0)],
        "customer_id string, country_code string, customer_segment string, last_order_date date, total_spend double",
    )


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([("P1", "Books"), ("P2", "Toys")], "product_id string, category string")


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_daily_trend_drops_days_outside_the_calendar(spark, fact):
    calendar = dates.dim_date(dates.date_span(spark), D(2024, 6, 1))
    assert rows(dashboard.revenue_trend_daily(fact, calendar)) == [
        (D(2024, 1, 1), 30.15, 2), (D(2024, 1, 31), 5.0, 1), (D(2024, 2, 1), 1.0, 1),
    ]
    assert rows(dashboard.revenue_trend_monthly(fact, calendar)) == [(D(2024, 1, 1), 35.15, 3), (D(2024, 2, 1), 1.0, 1)]


def test_category_revenue_is_sorted_and_inner(fact, products):
    assert rows(dashboard.revenue_by_category(fact, products)) == [("Toys", 27.1), ("Books", 15.05)]


def test_segment_mix(customers):
    assert rows(dashboard.segment_mix(customers)) == [("gold", 2), ("bronze", 1)]


def test_top_countries_by_customer_country(fact, customers):
    assert rows(dashboard.top_countries(fact, customers)) == [("IN", 30.15), ("US", 5.0), (None, 1.0)]
    assert rows(dashboard.top_countries(fact, customers, limit=1)) == [("IN", 30.15)]


def test_channel_performance(fact):
    assert rows(dashboard.channel_performance(fact)) == [("mobile", 2, 27.1, 13.55, 5.0), ("online", 3, 16.05, 5.35, -0.3)]


def test_churn_summary_orders_by_risk(customers):
    assert rows(dashboard.churn_summary(customers, D(2024, 7, 1))) == [
        ("High Risk", 1, 1.0), ("Medium Risk", 1, 5.0), ("Low Risk", 1, 30.15),
    ]
