from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstar.schemas import RAW_COLUMNS, RAW_ORDERS  # noqa: E402
from tillstar.session import builder  # noqa: E402

GOOD_ORDER = {
    "order_id": "ORD001",
    "customer_id": "C000001",
    "product_id": "P00001",
    "store_id": "S001",
    "category": "Books",
    "quantity": "2",
    "unit_price": "100.00",
    "discount_pct": "10",
    "order_date": "2024-03-05",
    "ship_date": "2024-03-08",
    "status": "completed",
    "country": "IN",
    "channel": "online",
    "payment": "upi",
}

STG_DEFAULTS = {
    "order_id": "O1",
    "customer_id": "C1",
    "product_id": "P1",
    "store_id": "S1",
    "product_category": "Books",
    "sales_channel": "online",
    "payment_method": "upi",
    "order_status": "completed",
    "country_code": "IN",
    "quantity": 1,
    "unit_price": 10.0,
    "discount_pct": 0,
    "gross_amount": 10.0,
    "discount_amount": 0.0,
    "net_amount": 10.0,
    "order_date": dt.date(2024, 1, 1),
    "ship_date": None,
    "days_to_ship": None,
}
STG_DDL = (
    "order_id string, customer_id string, product_id string, store_id string, product_category string, sales_channel string, "
    "payment_method string, order_status string, country_code string, quantity int, unit_price double, discount_pct int, "
    "gross_amount double, discount_amount double, net_amount double, order_date date, ship_date date, days_to_ship int"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests")
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    """Raw orders from partial rows: ``raw({...}, {...})``; missing fields come from a good order."""

    def build(*overrides):
        rows = [{**GOOD_ORDER, **o} for o in overrides]
        return spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in rows], RAW_ORDERS)

    return build


@pytest.fixture
def stg(spark):
    """Staging rows from partial rows; order ids are numbered unless given."""

    def build(*overrides):
        rows = [{**STG_DEFAULTS, "order_id": f"O{i}", **o} for i, o in enumerate(overrides)]
        return spark.createDataFrame([tuple(r[c] for c in STG_DEFAULTS) for r in rows], STG_DDL)

    return build


def by(frame, key):
    return {row[key]: row for row in frame.collect()}
