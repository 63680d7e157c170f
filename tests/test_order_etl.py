from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from tillstar.plans import orders_etl
from tillstar.plans.orders_etl import clean_orders, staged_orders
from tillstar.schemas import RAW_COLUMNS


def only(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]


class TestRejection:
    def test_null_key_drops_that_row_only(self, raw):
        kept = only(staged_orders(raw({"order_id": "A"}, {"order_id": None})))
        assert kept.order_id == "A"

    @pytest.mark.parametrize(
        "bad",
        [
            {"customer_id": None},
            {"product_id": None},
            {"order_date": None},
            {"order_date": "9999-99-99"},
            {"order_date": "2024-1-3"},
            {"order_date": "2024-02-30"},
            {"unit_price": None},
            {"unit_price": "-50.00"},
            {"unit_price": "0"},
            {"unit_price": "free"},
            {"quantity": None},
            {"quantity": "0"},
            {"quantity": "abc"},
            {"discount_pct": None},
            {"discount_pct": "-1"},
            {"discount_pct": "101"},
        ],
    )
    def test_invalid_order_is_dropped(self, raw, bad):
        assert staged_orders(raw(bad)).count() == 0

    @pytest.mark.parametrize("fine", [{"category": None}, {"ship_date": None}, {"country": None}, {"discount_pct": "100"}])
    def test_tolerated_gap_is_kept(self, raw, fine):
        assert staged_orders(raw(fine)).count() == 1


class TestTyping:
    @pytest.mark.parametrize(
        ("text", "number"),
        [("7", 7), (" 7 ", 7), ("+7", 7), ("2.5", 2), ("5.", 5), (".5", 0), ("-3.9", -3), ("abc", None), ("1e3", None),
         ("", None), ("99999999999", None), ("1.2.3", None), (None, None)],
    )
    def test_whole_number(self, raw, text, number):
        assert only(orders_etl.typed_orders(raw({"quantity": text}))).quantity == number

    @pytest.mark.parametrize(
        ("text", "day"),
        [("2024-02-29", "2024-02-29"), ("2023-02-29", None), ("2024-2-9", None), (" 2024-02-09", None),
         ("2024-02-09T00", None), ("2024-02-09\n", None), ("12024-02-09", None), (None, None)],
    )
    def test_iso_day(self, raw, text, day):
        got = only(orders_etl.typed_orders(raw({"ship_date": text}))).ship_date
        assert (got and got.isoformat()) == day


class TestDedup:
    def test_exact_copies_collapse(self, raw):
        assert staged_orders(raw({}, {})).count() == 1

    def test_different_orders_stay(self, raw):
        kept = staged_orders(raw({"order_id": "A"}, {"order_id": "B"}))
        assert kept.select("order_id").distinct().count() == kept.count() == 2

    @pytest.mark.parametrize(
        ("winner", "loser"),
        [
            ({"order_date": "2024-03-06"}, {"order_date": "2024-03-05"}),
            ({"ship_date": "2024-03-09"}, {"ship_date": "2024-03-08"}),
            ({"ship_date": "2024-03-08"}, {"ship_date": None}),
            ({"customer_id": "C000001"}, {"customer_id": "C000002"}),
            ({"product_id": "P00001"}, {"product_id": "P00002"}),
            ({"unit_price": "9.5"}, {"unit_price": "9.25"}),
            ({"quantity": "10"}, {"quantity": "9"}),
            # The criteria apply in order: a later one cannot overrule an earlier one.
            ({"order_date": "2024-03-06", "quantity": "1"}, {"order_date": "2024-03-05", "quantity": "9"}),
            ({"ship_date": "2024-03-09", "unit_price": "1"}, {"ship_date": None, "unit_price": "9"}),
        ],
    )
    def test_preference(self, raw, winner, loser):
        for rows in itertools.permutations([winner, loser]):
            kept = only(clean_orders(raw(*rows)))
            assert kept == only(clean_orders(raw(winner)))

    def test_rows_tied_on_all_criteria_resolve_the_same_way(self, raw):
        variants = [{"store_id": "S003"}, {"store_id": "S001", "payment": "cod"}, {"store_id": "S001", "payment": "upi"}]
        kept = {only(clean_orders(raw(*rows)).select("store_id", "payment")) for rows in itertools.permutations(variants)}
        assert kept == {("S001", "cod")}

    def test_invalid_copy_cannot_win(self, raw):
        kept = only(clean_orders(raw({"order_date": "2024-03-05"}, {"order_date": "2024-03-09", "quantity": "0"})))
        assert kept.order_date.isoformat() == "2024-03-05"

    def test_matches_brute_force_with_one_dominant_key(self, spark, raw):
        rows = [
            {"order_id": f"O{0 if i % 3 else i % 7}", "order_date": f"2024-01-{1 + i * 7 % 28:02d}",
             "ship_date": None if i % 5 == 0 else f"2024-02-{1 + i * 11 % 28:02d}", "quantity": str(1 + i % 9)}
            for i in range(300)
        ]
        got = {(r.order_id, str(r.order_date), r.ship_date and str(r.ship_date), r.quantity)
               for r in clean_orders(raw(*rows).repartition(8)).collect()}
        best = {}
        for r in rows:
            rank = (r["order_date"], r["ship_date"] or "", int(r["quantity"]))
            best[r["order_id"]] = max(best.get(r["order_id"], ("", "", 0)), rank)
        assert got == {(k, d, s or None, q) for k, (d, s, q) in best.items()}


class TestEnrichment:
    def test_gross(self, raw):
        assert only(staged_orders(raw({"quantity": "3", "unit_price": "100.00"}))).gross_amount == 300.0

    def test_net_and_discount(self, raw):
        row = only(staged_orders(raw({"quantity": "2", "unit_price": "100.00", "discount_pct": "20"})))
        assert (row.net_amount, row.discount_amount) == (160.0, 40.0)

    def test_calendar_parts(self, raw):
        row = only(staged_orders(raw({"order_date": "2024-07-15"})))
        assert (row.year, row.month, row.quarter, row.day_of_week) == (2024, 7, 3, 2)

    @pytest.mark.parametrize(("day", "weekend"), [("2024-01-13", True), ("2024-01-14", True), ("2024-01-15", False)])
    def test_weekend(self, raw, day, weekend):
        assert only(staged_orders(raw({"order_date": day, "ship_date": None}))).is_weekend is weekend

    @pytest.mark.parametrize(("ship", "days"), [("2024-03-08", 3), ("2024-03-01", -4), (None, None)])
    def test_days_to_ship(self, raw, ship, days):
        assert only(staged_orders(raw({"ship_date": ship}))).days_to_ship == days

    def test_load_time_is_set_and_columns_are_in_order(self, raw):
        staged = staged_orders(raw({}))
        assert staged.columns == [
            *RAW_COLUMNS, "discount_amount", "gross_amount", "net_amount", "year", "month", "quarter", "day_of_week",
            "is_weekend", "days_to_ship", "etl_loaded_at",
        ]
        assert only(staged).etl_loaded_at is not None


class TestNormalisation:
    @pytest.mark.parametrize(
        ("status", "clean"),
        [("COMPLETED", "completed"), ("  Returned ", "returned"), ("GARBAGE_STATUS", "unknown"), (None, "unknown"), ("", "unknown"),
         ("\tpending", "unknown")],
    )
    def test_status(self, raw, status, clean):
        assert only(clean_orders(raw({"status": status}))).status == clean

    def test_labels_and_codes(self, raw):
        row = only(clean_orders(raw({"channel": " In-Store", "payment": "UPI ", "country": " gb "})))
        assert (row.channel, row.payment, row.country) == ("in-store", "upi", "GB")


class TestAccounting:
    def test_funnel(self, raw):
        feed = raw({"order_id": "A"}, {"order_id": "A"}, {"order_id": "B"}, {"order_id": "C", "quantity": "x"})
        row = only(orders_etl.etl_funnel(feed))
        assert (row.raw_rows, row.clean_rows, row.rows_dropped, row.drop_rate_pct) == (4, 2, 2, 50.0)

    def test_funnel_of_nothing(self, raw):
        row = only(orders_etl.etl_funnel(raw({}).where(F.lit(False))))
        assert (row.raw_rows, row.clean_rows, row.rows_dropped, row.drop_rate_pct) == (0, 0, 0, None)

    def test_run_etl_writes_and_counts(self, spark, raw, tmp_path):
        feed = raw({"order_id": "A"}, {"order_id": "A"}, {"order_id": "B", "order_date": "2023-12-31"}, {"unit_price": None})
        summary = orders_etl.run_etl(feed, str(tmp_path / "staged"))
        assert (summary.raw_rows, summary.clean_rows, summary.rows_dropped, summary.drop_rate_pct) == (4, 2, 2, 50.0)
        assert (tmp_path / "staged" / "year=2023" / "month=12").is_dir()

    def test_run_etl_on_nothing(self, raw, tmp_path):
        summary = orders_etl.run_etl(raw({"order_id": None}), str(tmp_path / "staged"))
        assert (summary.clean_rows, summary.drop_rate_pct) == (0, 100.0)
