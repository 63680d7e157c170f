"""Exact money.

Amounts are stored as doubles with two decimals, but every product, sum and average is computed on
decimals or whole cents, so a result never depends on the order in which partitions are added up.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_PERCENT = Decimal("0.01")


def _share_of_price(unit_price: Column, quantity: Column, percent: Column | None) -> Column:
    # decimal(18,6) x decimal(10,0) x decimal(3,0) x 0.01 has at most 36 digits: nothing is rounded
    # before the final two-place rounding and the product cannot overflow.
    exact = unit_price.try_cast("decimal(18,6)") * quantity.cast("decimal(10,0)")
    approximate = unit_price * quantity
    if percent is not None:
        exact = exact * percent.try_cast("decimal(3,0)") * F.lit(_PERCENT)
        approximate = approximate * (percent / F.lit(100.0))
    # Prices beyond 12 integer digits do not fit the decimal; they keep the floating result.
    return F.coalesce(F.round(exact, 2).cast("double"), F.round(approximate, 2))


def gross(unit_price: Column, quantity: Column) -> Column:
    return _share_of_price(unit_price, quantity, None)


def discount(unit_price: Column, quantity: Column, discount_pct: Column) -> Column:
    return _share_of_price(unit_price, quantity, discount_pct)


def net(unit_price: Column, quantity: Column, discount_pct: Column) -> Column:
    return _share_of_price(unit_price, quantity, F.lit(100) - discount_pct)


def scaled(value: Column, digits: int) -> Column:
    """A double as a whole number of ``10^-digits`` units; NULL if it has none, as NaN, Infinity or 1e40.

    Twenty digits hold any amount a double can hold exactly, and leave room for the sum of 10^18 rows.
    """
    return F.rint(value * F.lit(float(10**digits))).try_cast("decimal(20,0)")


def cents(amount: Column) -> Column:
    return scaled(amount, 2)


def beyond(value: Column, digits: int = 2) -> Column:
    """The values that ``scaled`` has no whole number for. Their sum is kept beside the exact one, so that no value is lost."""
    return F.when(scaled(value, digits).isNull(), value)


def from_cents(total: Column, rest: Column | None = None) -> Column:
    """Amount of a sum of cents and, if there is any, of the sum of ``beyond``."""
    amount = total.cast("double") / F.lit(100.0)
    return amount if rest is None else F.when(rest.isNull(), amount).otherwise(F.coalesce(amount, F.lit(0.0)) + rest)


def average_amount(total_cents: Column, rows: Column, rest: Column | None = None) -> Column:
    return average(total_cents, rows, 2, rest)


def average(total: Column, rows: Column, scale: int, rest: Column | None = None) -> Column:
    """Mean with two decimals of ``rows`` values whose scaled sum is ``total``; ``rest`` as in from_cents."""
    exact = half_up_ratio(total, rows * F.lit(10**scale), 2)
    if rest is None:
        return exact
    return F.when(rest.isNull(), exact).otherwise((F.coalesce(total.cast("double") / F.lit(float(10**scale)), F.lit(0.0)) + rest) / rows)


def half_up_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """``round(numerator / denominator, digits)`` on whole numbers, ties away from zero.

    NULL when either side is NULL or the denominator is 0. Integer division avoids the double
    rounding of ``round(a / b)``.
    """
    divisor = F.nullif(denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    size = F.abs(numerator.cast("decimal(28,0)"))
    doubled = size * F.lit(Decimal(2 * 10**digits)) + divisor
    units = F.call_function("div", doubled, divisor * F.lit(Decimal(2))).cast("double")
    signed = F.when(numerator < 0, -units).otherwise(units)
    return signed / F.lit(float(10**digits))
