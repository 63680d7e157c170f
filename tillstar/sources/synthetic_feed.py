"""A noisy order feed of any size, and the noise on its own for an existing feed.

Every draw is a hash of (seed, purpose, row identity): a recomputed task regenerates the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.schemas import CATEGORIES, CHANNELS, COUNTRIES, ORDER_STATUSES, PAYMENTS, RAW_COLUMNS

# Volumes, price ranges, weights and noise rates of the feed.
CUSTOMERS, PRODUCTS, STORES, MAX_QUANTITY = 50_000, 5_000, 200, 10
PRICE_RANGES = {
    "Electronics": (50.00, 2000.00),
    "Clothing": (10.00, 300.00),
    "Food & Beverage": (2.00, 80.00),
    "Sports": (15.00, 500.00),
    "Home & Garden": (8.00, 400.00),
    "Books": (5.00, 60.00),
    "Toys": (5.00, 200.00),
}
STATUS_WEIGHTS = [0.65, 0.10, 0.12, 0.08, 0.05]
DISCOUNTS = [0, 5, 10, 15, 20]
ORDERED_BETWEEN = (dt.date(2023, 1, 1), dt.date(2024, 12, 31))
SHIPPED_BETWEEN = (dt.date(2023, 1, 2), dt.date(2025, 1, 15))
NULL_RATE, BAD_DATE_RATE, NEGATIVE_RATE, COPY_RATE = 0.03, 0.005, 0.002, 0.01
NULLED_COLUMNS = ["category", "country", "ship_date", "discount_pct"]
IMPOSSIBLE_DATE = "9999-99-99"


def draw(identity: Column, purpose: str, seed: int) -> Column:
    """A number in [0, 1), the same on every evaluation and every engine that has MD5."""
    digest = F.md5(F.concat_ws("|", F.lit(f"{seed}|{purpose}"), identity.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))


def pick(values: Sequence, fraction: Column) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.get(options, F.floor(fraction * len(values)).cast("int"))


def pick_weighted(values: Sequence, weights: Sequence[float], fraction: Column) -> Column:
    reached, choice = 0.0, None
    for value, weight in list(zip(values, weights))[:-1]:
        reached += weight
        test = fraction < reached
        choice = F.when(test, F.lit(value)) if choice is None else choice.when(test, F.lit(value))
    return choice.otherwise(F.lit(values[-1]))


def _numbered(prefix: str, digits: int, limit: int, fraction: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad((F.floor(fraction * limit) + 1).cast("string"), digits, "0"))


def _day_between(span: tuple[dt.date, dt.date], fraction: Column) -> Column:
    days = (span[1] - span[0]).days + 1
    return F.date_add(F.lit(span[0]), F.floor(fraction * days).cast("int")).cast("string")


def clean_feed(spark: SparkSession, rows: int, seed: int = 42) -> DataFrame:
    """``rows`` well-formed raw orders."""

    def of(purpose: str) -> Column:
        return draw(F.col("id"), purpose, seed)

    prices = F.create_map(*[F.lit(x) for name, (low, high) in PRICE_RANGES.items() for x in (name, low)])
    spreads = F.create_map(*[F.lit(x) for name, (low, high) in PRICE_RANGES.items() for x in (name, high - low)])
    digest = F.md5(F.concat(F.lit(f"{seed}|order|"), F.col("id").cast("string")))
    order_id = F.regexp_replace(digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    category = pick(CATEGORIES, of("category"))
    price = F.element_at(prices, F.col("category")) + F.element_at(spreads, F.col("category")) * of("price")
    return (
        spark.range(rows)
        .withColumn("category", category)
        .select(
            order_id.alias("order_id"),
            _numbered("C", 6, CUSTOMERS, of("customer")).alias("customer_id"),
            _numbered("P", 5, PRODUCTS, of("product")).alias("product_id"),
            _numbered("S", 3, STORES, of("store")).alias("store_id"),
            "category",
            (F.floor(of("quantity") * MAX_QUANTITY) + 1).cast("string").alias("quantity"),
            price.cast("decimal(12,2)").cast("string").alias("unit_price"),
            pick(DISCOUNTS, of("discount")).cast("string").alias("discount_pct"),
            _day_between(ORDERED_BETWEEN, of("ordered")).alias("order_date"),
            _day_between(SHIPPED_BETWEEN, of("shipped")).alias("ship_date"),
            pick_weighted(ORDER_STATUSES, STATUS_WEIGHTS, of("status")).alias("status"),
            pick(COUNTRIES, of("country")).alias("country"),
            pick(CHANNELS, of("channel")).alias("channel"),
            pick(PAYMENTS, of("payment")).alias("payment"),
        )
    )


def with_noise(feed: DataFrame, identity: Column, seed: int = 42) -> DataFrame:
    """Plant missing values, impossible dates, negative prices and exact copies."""

    def of(purpose: str) -> Column:
        return draw(identity, purpose, seed)

    victim = F.when(of("null") < NULL_RATE, pick(NULLED_COLUMNS, of("victim")))
    price = F.col("unit_price")
    changed = {name: F.when(victim.eqNullSafe(F.lit(name)), F.lit(None)).otherwise(F.col(name)) for name in NULLED_COLUMNS}
    changed["order_date"] = F.when(of("date") < BAD_DATE_RATE, F.lit(IMPOSSIBLE_DATE)).otherwise(F.col("order_date"))
    changed["unit_price"] = F.when(
        of("sign") < NEGATIVE_RATE, F.concat(F.lit("-"), F.regexp_replace(price, "^-", ""))
    ).otherwise(price)
    copies = F.when(of("copy") < COPY_RATE, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    noisy = feed.select(*[changed.get(c, F.col(c)).alias(c) for c in RAW_COLUMNS], copies.alias("_copies"))
    return noisy.withColumn("_copy", F.explode("_copies")).select(*RAW_COLUMNS)


def noisy_feed(spark: SparkSession, rows: int, seed: int = 42) -> DataFrame:
    return with_noise(clean_feed(spark, rows, seed), F.col("order_id"), seed)
