"""Registered queries on the driver tables."""

from __future__ import annotations

import os

import duckdb
import pytest
from tillstar.llm import queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not on this machine")


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.registered()) == list(range(1, 14))
    assert set(queries.statements()) <= set(queries.registered())


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in os.listdir(SF_DIR):
        duck.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{table}'")
    result = duck.execute(queries.statements()[name])
    names = [column[0] for column in result.description]
    frame = queries.registered()[name](spark, SF_DIR)
    assert sorted(frame.columns) == sorted(names)
    assert sorted(map(str, frame.select(*names).collect())) == sorted(str(r) for r in map(spark_row(names), result.fetchall()))


def spark_row(names):
    from pyspark.sql import Row

    return lambda values: Row(**dict(zip(names, values, strict=True)))
