from __future__ import annotations

import datetime as dt
import hashlib
import random

import pytest

from tillstar.operators.history import VALID_FROM, VALID_TO, VERSION_ID, open_versions, scd2_merge

DDL = "customer_id string, segment string, spend double, note string"
CHECKS = ["segment", "spend"]
RUNS = [dt.datetime(2024, m, 1) for m in range(1, 10)]


def run(spark, inputs, **options):
    """History after feeding each input, a dict of key to (segment, spend, note)."""
    history = None
    for at, rows in zip(RUNS, inputs):
        frame = spark.createDataFrame([(k, *v) for k, v in rows.items()], DDL)
        history = open_versions(frame, "customer_id", at) if history is None else scd2_merge(history, frame, "customer_id", CHECKS, at, **options)
    return history


def periods(history):
    return sorted(
        (r.customer_id, r.segment, r.spend, r.note, r[VALID_FROM].month, r[VALID_TO] and r[VALID_TO].month)
        for r in history.collect()
    )


def brute_force(inputs, close_missing=True):
    versions = []
    for at, rows in zip(RUNS, inputs):
        for v in [v for v in versions if v["to"] is None]:
            now = rows.get(v["key"])
            if (now is None and close_missing) or (now is not None and now[:2] != v["row"][:2]):
                v["to"] = at.month
        still_open = {v["key"] for v in versions if v["to"] is None}
        versions += [{"key": k, "row": r, "from": at.month, "to": None} for k, r in rows.items() if k not in still_open]
    return sorted((v["key"], *v["row"], v["from"], v["to"]) for v in versions)


def test_new_changed_unchanged_deleted_and_returning(spark):
    first = {"same": ("gold", 1.0, "a"), "moved": ("silver", 2.0, "a"), "gone": ("gold", 3.0, "a")}
    second = {"same": ("gold", 1.0, "b"), "moved": ("gold", 2.0, "a"), "new": ("bronze", 0.5, "a")}
    third = {"same": ("gold", 1.0, "c"), "moved": ("gold", 2.0, "a"), "new": ("bronze", 0.5, "a"), "gone": ("gold", 3.0, "a")}
    assert periods(run(spark, [first, second, third])) == sorted([
        ("same", "gold", 1.0, "a", 1, None),
        ("moved", "silver", 2.0, "a", 1, 2),
        ("moved", "gold", 2.0, "a", 2, None),
        ("new", "bronze", 0.5, "a", 2, None),
        ("gone", "gold", 3.0, "a", 1, 2),
        ("gone", "gold", 3.0, "a", 3, None),
    ])


def test_missing_keys_stay_open_on_request(spark):
    assert periods(run(spark, [{"k": ("gold", 1.0, "a")}, {"j": ("gold", 1.0, "a")}], close_missing=False)) == [
        ("j", "gold", 1.0, "a", 2, None), ("k", "gold", 1.0, "a", 1, None),
    ]


@pytest.mark.parametrize(("before", "after", "versions"), [(None, None, 1), (None, "gold", 2), ("gold", None, 2)])
def test_null_in_a_checked_column(spark, before, after, versions):
    assert run(spark, [{"k": (before, 1.0, "a")}, {"k": (after, 1.0, "a")}]).count() == versions


def test_version_id_is_md5_of_key_and_time(spark):
    row = run(spark, [{"k": ("gold", 1.0, "a")}]).first()
    assert row[VERSION_ID] == hashlib.md5(b"k|2024-01-01 00:00:00").hexdigest()


@pytest.mark.parametrize("seed", range(2))
def test_random_runs_match_brute_force(spark, seed):
    rng = random.Random(seed)
    inputs = [
        {f"k{i}": (rng.choice(["gold", "silver"]), rng.choice([1.0, 2.0]), "n") for i in range(25) if rng.random() < 0.7} for _ in range(4)
    ]
    got = run(spark, inputs)
    assert periods(got) == brute_force(inputs)
    assert got.select(VERSION_ID).distinct().count() == got.count()
