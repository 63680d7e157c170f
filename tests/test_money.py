from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction
import random

from pyspark.sql import functions as F

from tillstar.functions import money


def half_up(value: Fraction, digits: int) -> float:
    scaled = abs(value) * 10**digits
    units = int(scaled + Fraction(1, 2))
    return (-units if value < 0 else units) / 10**digits


def test_amounts_equal_exact_decimal_arithmetic(spark):
    rng = random.Random(7)
    rows = [(rng.randint(1, 1_000_000) / 100, rng.randint(1, 100), rng.randint(0, 100)) for _ in range(3000)]
    rows += [(0.05, 1, 10), (1.005, 1, 0), (2.5, 1, 1), (0.333333, 3, 0), (9.999, 3, 0)]
    frame = spark.createDataFrame(rows, "p double, q int, d int")
    p, q, d = F.col("p"), F.col("q"), F.col("d")
    for row in frame.select("p", "q", "d", money.gross(p, q).alias("g"), money.discount(p, q, d).alias("c"), money.net(p, q, d).alias("n")).collect():
        base = Decimal(str(row.p)) * row.q

        def cents(x):
            return float(x.quantize(Decimal("0.01"), ROUND_HALF_UP))

        assert row.g == cents(base)
        assert row.c == cents(base * row.d / 100)
        assert row.n == cents(base * (100 - row.d) / 100)


def test_prices_beyond_the_decimal_range_keep_the_floating_result(spark):
    row = spark.createDataFrame([(1e15, 3, 50)], "p double, q int, d int").select(
        money.gross(F.col("p"), F.col("q")).alias("g"), money.net(F.col("p"), F.col("q"), F.col("d")).alias("n")
    ).first()
    assert (row.g, row.n) == (3e15, 1.5e15)


def test_ratio_rounds_half_away_from_zero(spark):
    rng = random.Random(11)
    rows = [(rng.randint(-10**6, 10**6), rng.randint(1, 400)) for _ in range(2000)] + [(1, 8), (-1, 8), (5, 1000), (0, 3)]
    frame = spark.createDataFrame(rows, "a bigint, b bigint")
    for digits in (1, 2):
        for row in frame.select("a", "b", money.half_up_ratio(F.col("a"), F.col("b"), digits).alias("r")).collect():
            assert row.r == half_up(Fraction(row.a, row.b), digits)


def test_ratio_without_a_value(spark):
    frame = spark.createDataFrame([(1, 0), (None, 3), (3, None)], "a bigint, b bigint")
    assert [r[0] for r in frame.select(money.half_up_ratio(F.col("a"), F.col("b"), 2)).collect()] == [None, None, None]


def test_sums_do_not_depend_on_partitioning(spark):
    frame = spark.range(20_000).select(((F.col("id") * 7919 % 100_003) / 100.0).alias("x"))
    expected = sum(i * 7919 % 100_003 for i in range(20_000)) / 100
    for parts in (1, 7):
        total = frame.repartition(parts).agg(money.from_cents(F.sum(money.cents(F.col("x"))))).first()[0]
        assert total == expected


def test_amounts_without_a_decimal_form_are_kept(spark):
    """NaN shows in every figure it belongs to, and 1e40 stops nothing."""
    def figures(*amounts):
        x = F.col("x")
        frame = spark.createDataFrame([(a,) for a in amounts], "x double")
        total, rest, rows = F.sum(money.cents(x)), F.sum(money.beyond(x)), F.count("x")
        return frame.agg(money.from_cents(total, rest).alias("t"), money.average_amount(total, rows, rest).alias("a")).first()

    assert tuple(figures(80.0, 100.0, None)) == (180.0, 90.0)
    assert all(v != v for v in figures(float("nan"), 100.0))
    assert tuple(figures(float("inf"), 100.0)) == (float("inf"), float("inf"))
    assert tuple(figures(1e40, 100.0)) == (1e40, 5e39)
    assert tuple(figures(None)) == (None, None)
