"""Order of rows inside a table, so that statistics of files and row groups skip what a filter doesn't want.

Rows are range-partitioned and sorted by leading columns and then along a space-filling curve over further keys: each key's
values are cut into ranges of about equal weight, and the bits of the range numbers are interleaved. So rows that
are close in any of the keys lie close together, and a row group spans a narrow part of each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a range number: each key is cut into 2^BITS ranges.
BITS = 5
#: Bytes of a text that order it; seven fit a whole number.
WIDTH = 7


def _position(name: str, shared: int) -> Column:
    """A text's place in byte order, from the bytes after those that all values share."""
    shown = F.rpad(F.hex(F.substring(F.encode(F.col(name), "UTF-8"), shared + 1, WIDTH)), 2 * WIDTH, "0")
    return F.coalesce(F.conv(shown, 16, 10).cast("long"), F.lit(-1))


def _range_number(position: Column, bounds: Sequence[int]) -> Column:
    """How many bounds are at or below a position, by bisection."""
    if not bounds:
        return F.lit(0)
    middle = len(bounds) // 2
    low, high = _range_number(position, bounds[:middle]), _range_number(position, bounds[middle + 1 :])
    return F.when(position < F.lit(bounds[middle]), low).otherwise(high + F.lit(middle + 1))


def curve(rows: DataFrame, names: Sequence[str], bits: int = BITS) -> Column:
    """Place on the curve over text columns; their ranges are measured on the rows, which are read twice for these columns only."""
    ends = rows.agg(*[f(n).alias(f"{f.__name__}_{n}") for n in names for f in (F.min, F.max)]).first()
    shared = [_shared_bytes(ends[f"min_{n}"], ends[f"max_{n}"]) for n in names]
    shares = [i / 2**bits for i in range(1, 2**bits)]
    cuts = rows.agg(*[F.percentile_approx(_position(n, k), shares).alias(n) for n, k in zip(names, shared, strict=True)]).first()
    numbers = [_range_number(_position(n, k), sorted(set(cuts[n] or []))) for n, k in zip(names, shared, strict=True)]
    place = F.lit(0)
    for bit in range(bits):
        for i, number in enumerate(numbers):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1))
            place = place + F.shiftleft(one, bit * len(names) + i)
    return place


def _shared_bytes(least: str | None, most: str | None) -> int:
    """Bytes that begin both, and so everything between them."""
    a, b = (least or "").encode(), (most or "").encode()
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def clustered(rows: DataFrame, leading: Sequence[str], place: Column) -> DataFrame:
    """Rows dealt out and sorted by the leading columns, then by their place on the curve. Partitions are equal in size, whatever the values."""
    placed = rows.withColumn("_place", place)
    order = [*leading, "_place"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_place")
