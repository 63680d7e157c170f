"""The declared tests of the loaded orders and the star schema, and a report over all of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.contracts import combine
from tillstar.operators.dedup import repeated_values
from tillstar.operators.integrity import orphan_keys
from tillstar.schemas import ACCEPTED_STATUSES, CHURN_RISKS, REVENUE_TIERS, SEGMENTS


@dataclass(frozen=True)
class RowTest:
    """Counts rows for which the condition is true; all row tests of a table share one scan."""

    kind: str
    column: str
    offends: str
    severity: str = "error"


@dataclass(frozen=True)
class UniqueTest:
    """Counts repeated values; all unique tests of a table share one scan and one shuffle."""

    column: str
    kind: str = "unique"
    severity: str = "error"


@dataclass(frozen=True)
class ParentTest:
    """Counts child rows without a parent."""

    column: str
    parent: str
    severity: str = "error"
    kind: str = "relationships"


def _filled(*columns: str) -> list[RowTest]:
    return [RowTest("not_null", c, f"{c} IS NULL") for c in columns]


def _one_of(column: str, values: Sequence) -> RowTest:
    return RowTest("accepted_values", column, f"{column} NOT IN ({', '.join(map(repr, values))})")


def _holds(column: str, expression: str, where: str | None = None) -> RowTest:
    scope = "" if where is None else f"({where}) AND "
    return RowTest("expression_is_true", column, f"{scope}NOT ({column} {expression})")


def _unique(*columns: str) -> list[UniqueTest]:
    return [UniqueTest(c) for c in columns]


def declared_tests() -> dict[str, list]:
    """Tests per table. Parent keys carry the same name as the child column."""
    return {
        "raw_orders": [
            *_filled("order_id", "customer_id", "product_id", "unit_price", "quantity", "order_date"),
            *_unique("order_id"),
            ParentTest("customer_id", "dim_customers", "warn"),
            _holds("unit_price", "> 0"),
            _holds("quantity", "> 0"),
            _one_of("status", ACCEPTED_STATUSES),
        ],
        "fct_sales": [
            *_filled("sale_key", "order_id", "customer_id", "product_id", "date_key", "net_amount", "quantity"),
            *_unique("sale_key", "order_id"),
            ParentTest("customer_id", "dim_customers"),
            ParentTest("product_id", "dim_products"),
            ParentTest("date_key", "dim_date"),
            _one_of("order_status", ACCEPTED_STATUSES),
            _holds("net_amount", ">= 0"),
            _holds("quantity", "> 0"),
            _holds("gross_amount", ">= net_amount", where="discount_pct > 0"),
        ],
        "dim_customers": [
            *_filled("customer_key", "customer_id"),
            *_unique("customer_key", "customer_id"),
            _one_of("customer_segment", SEGMENTS),
            _one_of("churn_risk", CHURN_RISKS),
            _holds("total_spend", ">= 0"),
            _holds("total_orders", "> 0"),
        ],
        "dim_products": [
            *_filled("product_key", "product_id"),
            *_unique("product_key", "product_id"),
            _one_of("revenue_tier", REVENUE_TIERS),
            _holds("return_rate_pct", "BETWEEN 0 AND 100"),
        ],
        "dim_date": [
            *_filled("date_key", "full_date"),
            *_unique("date_key", "full_date"),
            _one_of("quarter", [1, 2, 3, 4]),
        ],
    }


def _lines(counted: DataFrame, table: str, tests: Sequence, failures: Sequence[str]) -> DataFrame:
    """One report line per test from a single row of failure counts."""
    structs = [
        f"named_struct('table_name', '{table}', 'column_name', '{t.column}', 'test', '{t.kind}', "
        f"'status', if({n} = 0, 'pass', '{t.severity}'), 'failures', {n})"
        for t, n in zip(tests, failures)
    ]
    return counted.selectExpr(f"inline(array({', '.join(structs)}))")


def _row_results(table: str, rows: DataFrame, tests: Sequence[RowTest]) -> DataFrame:
    names = [f"t{i}" for i in range(len(tests))]
    counted = rows.agg(*[F.expr(f"count_if({t.offends}) AS {n}") for t, n in zip(tests, names)])
    return _lines(counted, table, tests, names)


def _unique_results(table: str, rows: DataFrame, tests: Sequence[UniqueTest]) -> DataFrame:
    columns = [t.column for t in tests]
    return _lines(repeated_values(rows, columns), table, tests, columns)


def _parent_results(table: str, rows: DataFrame, test: ParentTest, parent: DataFrame) -> DataFrame:
    lost = orphan_keys(rows, test.column, parent, test.column)
    return _lines(lost.agg(F.expr("coalesce(sum(orphan_rows), 0L) AS n")), table, [test], ["n"])


def table_results(table: str, tables: dict[str, DataFrame], parents: bool = True) -> list[DataFrame]:
    rows, tests = tables[table], declared_tests()[table]
    between = [t for t in tests if isinstance(t, ParentTest) and parents]
    return [
        _row_results(table, rows, [t for t in tests if isinstance(t, RowTest)]),
        _unique_results(table, rows, [t for t in tests if isinstance(t, UniqueTest)]),
        *[_parent_results(table, rows, t, tables[t.parent]) for t in between],
    ]


def own_report(table: str, rows: DataFrame) -> DataFrame:
    """The tests of a table that need no other table."""
    return combine(table_results(table, {table: rows}, parents=False))


def declared_report(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, column_name, test, status, failures)``, one line per declared test."""
    return combine([frame for table in declared_tests() for frame in table_results(table, tables)])
