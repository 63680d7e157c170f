"""From raw text orders to staged orders: type, filter, normalise, deduplicate, enrich."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions import calendar, casting, money, text
from tillstar.operators.dedup import keep_best, total_preference
from tillstar.operators.funnel import funnel
from tillstar.sources.commits import CommittedTable
from tillstar.sources.staging_area import LAYOUT, write_staged
from tillstar.sources.workspace import by_partition

MANDATORY = ["order_id", "customer_id", "product_id", "order_date", "unit_price"]


def typed_orders(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "quantity": casting.whole_number(F.col("quantity")),
            "unit_price": casting.real_number(F.col("unit_price")),
            "discount_pct": casting.whole_number(F.col("discount_pct")),
            "order_date": casting.iso_day(F.col("order_date")),
            "ship_date": casting.iso_day(F.col("ship_date")),
        }
    )


def is_valid_order() -> Column:
    """Keys present, price and quantity positive, discount a percentage. Unknown means invalid."""
    present = [F.col(name).isNotNull() for name in MANDATORY]
    sound = [F.col("unit_price") > 0, F.col("quantity") > 0, F.col("discount_pct").between(0, 100)]
    return reduce(and_, present + sound)


def valid_orders(typed: DataFrame) -> DataFrame:
    return typed.where(is_valid_order())


def normalised_orders(valid: DataFrame) -> DataFrame:
    return valid.withColumns(
        {
            "status": text.order_status(F.col("status")),
            "channel": text.label(F.col("channel")),
            "payment": text.label(F.col("payment")),
            "country": text.code(F.col("country")),
        }
    )


def deduped_orders(normalised: DataFrame) -> DataFrame:
    """The latest row of each order; the remaining columns settle what the main criteria leave tied."""
    leading = {
        "order_date": F.col("order_date").desc(),
        "ship_date": F.col("ship_date").desc_nulls_last(),
        "customer_id": F.col("customer_id").asc(),
        "product_id": F.col("product_id").asc(),
        "unit_price": F.col("unit_price").desc(),
        "quantity": F.col("quantity").desc(),
    }
    # The key is constant within its group and need not take part in the ordering.
    candidates = normalised.drop("order_id")
    return keep_best(normalised, "order_id", total_preference(candidates, leading))


def enriched_orders(orders: DataFrame) -> DataFrame:
    price, quantity, percent, day = (F.col(c) for c in ("unit_price", "quantity", "discount_pct", "order_date"))
    return orders.withColumns(
        {
            "discount_amount": money.discount(price, quantity, percent),
            "gross_amount": money.gross(price, quantity),
            "net_amount": money.net(price, quantity, percent),
            "year": F.year(day),
            "month": F.month(day),
            "quarter": F.quarter(day),
            "day_of_week": calendar.order_weekday(day),
            "is_weekend": calendar.falls_on_weekend(day),
            "days_to_ship": F.datediff("ship_date", day),
            "etl_loaded_at": calendar.load_time(),
        }
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    return raw.transform(typed_orders).transform(valid_orders).transform(normalised_orders).transform(deduped_orders)


def staged_orders(raw: DataFrame) -> DataFrame:
    return raw.transform(clean_orders).transform(enriched_orders)


def staged_by_month(raw: DataFrame) -> DataFrame:
    """The same rows in order for the staged layout, brought together before the derived columns are there: those follow from the row and need not move."""
    months = {c: derive("order_date") for c, derive in zip(LAYOUT, (F.year, F.month), strict=True)}
    together = by_partition(clean_orders(raw).withColumns(months), LAYOUT)
    return together.drop(*LAYOUT).transform(enriched_orders)


def etl_funnel(raw: DataFrame) -> DataFrame:
    return funnel(typed_orders(raw), "order_id", is_valid_order())


@dataclass(frozen=True)
class EtlSummary:
    raw_rows: int
    clean_rows: int

    @property
    def rows_dropped(self) -> int:
        return self.raw_rows - self.clean_rows

    @property
    def drop_rate_pct(self) -> float:
        return round(100.0 * self.rows_dropped / self.raw_rows, 1) if self.raw_rows else 0.0


def run_etl(raw: DataFrame, path: str, months: Collection[tuple[int, int]] | None = None) -> EtlSummary:
    """Stage a feed, or only some months of it, reading it once.

    The raw rows are landed beside the staged set, as text in columns. Their number comes from the written footers, so it stays
    exact when tasks are repeated, and the ETL reads columns instead of parsing lines.
    """
    landing = CommittedTable(raw.sparkSession, f"{path.rstrip('/')}/feed")
    landed = landing.write(raw, arrange=False, retained=1)
    clean = write_staged(staged_by_month(landing.read(landed)), path, months, arrange=False)
    return EtlSummary(landed.rows, clean)
