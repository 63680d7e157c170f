"""Product dimension: sales, returns and revenue tier per product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions import keys
from tillstar.functions.calendar import load_time
from tillstar.functions.money import average, beyond, cents, from_cents, half_up_ratio, scaled
from tillstar.operators.modes import likeliest, modal_value
from tillstar.operators.tiers import rank_tier
from tillstar.sources.workspace import persisted

# Rank limits of the revenue tiers.
TIERS = [(100, "top_100"), (500, "top_500")]
LOWEST_TIER = "standard"
PRICE_DIGITS = 6


def product_category_mode(stg: DataFrame) -> DataFrame:
    return modal_value(stg, "product_id", "product_category", alias="category")


def product_revenue(stg: DataFrame) -> DataFrame:
    """Revenue per product; NULL when no order of the product has an amount."""
    net = F.col("net_amount")
    summed = stg.groupBy("product_id").agg(F.sum(cents(net)).alias("cents"), F.sum(beyond(net)).alias("rest"))
    return summed.select("product_id", from_cents(F.col("cents"), F.col("rest")).alias("total_revenue"))


def product_partials(stg: DataFrame, *by: str) -> DataFrame:
    """Sums per (product, category), and per ``by`` if given; sums of any of them are the sums of their orders."""
    return stg.groupBy(*by, "product_id", "product_category").agg(
        F.count("order_id").alias("orders"),
        F.count(F.lit(1)).alias("weight"),
        F.sum("quantity").alias("units"),
        F.sum(cents(F.col("net_amount"))).alias("net_cents"),
        F.sum(beyond(F.col("net_amount"))).alias("net_rest"),
        F.sum(scaled(F.col("unit_price"), PRICE_DIGITS)).alias("price_units"),
        F.sum(beyond(F.col("unit_price"), PRICE_DIGITS)).alias("price_rest"),
        F.count("unit_price").alias("price_rows"),
        F.sum("discount_pct").alias("discounts"),
        F.count("discount_pct").alias("discount_rows"),
        F.count_if(F.col("order_status") == "returned").alias("returns"),
    )


def product_buyers(stg: DataFrame, *by: str) -> DataFrame:
    """Who bought what, once each, and per ``by`` if given."""
    return stg.select(*by, "product_id", "customer_id").distinct()


def product_metrics(partials: DataFrame, buyers: DataFrame) -> DataFrame:
    """Sums per product, its modal category and its distinct buyers. Both sides are hashed on product_id, so joining them moves no data again."""
    names = [c for c in partials.columns if c not in ("product_id", "product_category", "order_year", "order_month")]
    per_category = partials.groupBy("product_id", "product_category").agg(*[F.sum(c).alias(c) for c in names])
    per_product = per_category.groupBy("product_id").agg(
        likeliest(F.col("product_category"), F.col("weight")).alias("category"),
        F.sum("orders").alias("total_orders"),
        F.sum("units").alias("total_units_sold"),
        from_cents(F.sum("net_cents"), F.sum("net_rest")).alias("total_revenue"),
        F.sum("price_units").alias("price_units"),
        F.sum("price_rest").alias("price_rest"),
        F.sum("price_rows").alias("price_rows"),
        F.sum("discounts").alias("discounts"),
        F.sum("discount_rows").alias("discount_rows"),
        F.sum("returns").alias("return_count"),
    )
    counted = buyers.groupBy("product_id").agg(F.count_distinct("customer_id").alias("unique_buyers"))
    # Orders without a product are a group of their own.
    other = counted.withColumnRenamed("product_id", "buyers_of")
    return per_product.join(other, F.col("product_id").eqNullSafe(F.col("buyers_of"))).drop("buyers_of")


def dim_products(stg: DataFrame) -> DataFrame:
    return products_from(product_partials(stg), stg.select("product_id", "customer_id"))


def products_from(partials: DataFrame, buyers: DataFrame) -> DataFrame:
    """The dimension from partial sums and buyers. Metrics are written once: tiers compare them with the largest revenues of all."""
    metrics = persisted(product_metrics(partials, buyers), "product_metrics", shuffle=False)
    tier = rank_tier(metrics, "total_revenue", TIERS, LOWEST_TIER)
    return metrics.select(
        keys.surrogate_key("product_id").alias("product_key"),
        "product_id",
        "category",
        "total_orders",
        "total_units_sold",
        "total_revenue",
        average(F.col("price_units"), F.col("price_rows"), PRICE_DIGITS, F.col("price_rest")).alias("avg_selling_price"),
        half_up_ratio(F.col("discounts"), F.col("discount_rows"), 1).alias("avg_discount_pct"),
        "return_count",
        "unique_buyers",
        return_rate(F.col("return_count"), F.col("total_orders")).alias("return_rate_pct"),
        tier.alias("revenue_tier"),
        load_time().alias("dbt_updated_at"),
    )


def return_rate(returned, orders):
    return half_up_ratio(returned * 100, orders, 2)
