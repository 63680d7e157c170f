"""Commits: races, failures, leftovers, replaced months, fresh views and a history that grows by parts."""

from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillstar.operators.history import VALID_TO
from tillstar.plans import customer_history, orders_etl
from tillstar.sources import snapshots
from tillstar.sources.commits import KEPT_COMMITS, CommittedTable, ConcurrentWrite
from tillstar.sources.staging_area import read_staged, write_staged

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def table(spark, tmp_path):
    return CommittedTable(spark, str(tmp_path / "table"))


def ids(frame):
    return sorted(r[0] for r in frame.select(frame.columns[0]).collect())


def files(folder) -> dict[str, float]:
    """Parquet files below a folder and when they were written."""
    found = [os.path.join(top, name) for top, _, names in os.walk(folder) for name in names if name.endswith(".parquet")]
    return {f: os.stat(f).st_mtime_ns for f in found}


def parts(table) -> set[str]:
    return {name for name, _ in table._children(f"{table.root}/data")}


class TestCommits:
    def test_a_commit_replaces_or_adds(self, spark, table):
        table.write(spark.range(3))
        assert ids(table.read()) == [0, 1, 2]
        table.write(spark.range(5, 7))
        assert ids(table.read()) == [5, 6]
        third = table.write(spark.range(9, 10), keep=lambda folder: True)
        assert ids(table.read()) == [5, 6, 9] and third.rows == 3
        assert ids(table.read(table.commit(1))) == [0, 1, 2]

    def test_the_later_of_two_writers_gets_an_error(self, spark, table):
        base = table.write(spark.range(1))
        table.write(spark.range(2), base=base)
        with pytest.raises(ConcurrentWrite, match="commit 2"):
            table.write(spark.range(3), base=base)
        assert ids(table.read()) == [0, 1] and len(parts(table)) == 2

    def test_two_processes_race(self, spark, table, tmp_path):
        """Both begin with the same commit and wait for each other before they publish."""
        table.write(spark.range(1))
        code = f"""
            import os, sys, time
            from tillstar.session import local_session
            from tillstar.sources.commits import CommittedTable, ConcurrentWrite
            spark = local_session(1, "1g")
            def meet(written):
                open({str(tmp_path)!r} + "/" + sys.argv[1], "w").close()
                while not all(os.path.exists({str(tmp_path)!r} + "/" + x) for x in "ab"):
                    time.sleep(0.01)
                return {{}}
            try:
                CommittedTable(spark, {table.root!r}).write(spark.range(10, 12), check=meet)
                print("won")
            except ConcurrentWrite:
                print("lost")
        """
        environment = os.environ | {"PYTHONPATH": ROOT}
        command = [sys.executable, "-c", textwrap.dedent(code)]
        both = [subprocess.Popen([*command, name], env=environment, cwd=tmp_path, stdout=subprocess.PIPE, text=True) for name in "ab"]
        assert sorted(p.communicate(timeout=300)[0].split()[-1] for p in both) == ["lost", "won"]
        assert ids(table.read()) == [10, 11] and table.numbers() == [1, 2] and len(parts(table)) == 2

    def test_failures_leave_nothing(self, spark, table):
        table.write(spark.range(2))

        def refuse(written):
            raise ValueError("no")

        with pytest.raises(ValueError):
            table.write(spark.range(3), check=refuse)
        with pytest.raises(PySparkException):
            table.write(spark.range(3).select(F.raise_error(F.lit("stop")).alias("id")))
        assert ids(table.read()) == [0, 1] and len(parts(table)) == 1 and len(os.listdir(f"{table.root}/log")) == 1

    def test_leftovers_of_a_killed_writer_go_and_running_writers_stay(self, spark, table):
        table.write(spark.range(2))
        dead, running = f"{table.root}/data/_part=00000002-dead", f"{table.root}/data/_part=00000003-running"
        for path in (dead, running):
            spark.range(4).write.parquet(path)
        assert table.collect() == [] and ids(table.read()) == [0, 1]
        table.write(spark.range(1))
        assert not os.path.exists(dead) and os.path.exists(running)

    def test_old_commits_go_with_their_folders(self, spark, table):
        for i in range(KEPT_COMMITS + 3):
            table.write(spark.range(i, i + 1))
        assert len(table.numbers()) == KEPT_COMMITS == len(parts(table))

    def test_tables_without_rows(self, spark, table):
        none = spark.createDataFrame([], "a int, b string, y int")
        table.write(none, ("y",))
        assert table.read().dtypes == none.dtypes and spark.sql(table.statement()).dtypes == none.dtypes
        assert table.read().count() == spark.sql(table.statement()).count() == table.latest().rows == 0
        table.write(spark.createDataFrame([(1, "x", None), (2, "y", 3)], none.schema), ("y",))
        assert sorted(map(str, spark.sql(table.statement()).collect())) == sorted(map(str, table.read().collect()))
        assert table.read().count() == 2

    def test_a_view_reads_the_newest_commit_and_no_other_folder(self, spark, table):
        table.write(spark.range(10).selectExpr("id", "id % 2 AS y"), ("y",))
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW fresh AS {table.statement()}")
        assert spark.table("fresh").count() == 10
        table.write(spark.range(10, 14).selectExpr("id", "id % 2 AS y"), ("y",), keep=lambda f: f.endswith("y=0"))
        assert ids(spark.table("fresh")) == [0, 2, 4, 6, 8, 10, 11, 12, 13]
        frame = spark.table("fresh").where("y = 1")
        assert ids(frame) == [11, 13]
        scan = frame._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(y" in scan and "array_contains" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]


class TestPublication:
    def test_views_follow_what_is_published_later(self, spark, raw):
        rows = orders_etl.staged_orders(raw({"order_id": "A"}, {"order_id": "B"}))
        snapshots.save_table(rows.where("order_id = 'A'"), "later_orders", ("year", "month"))
        snapshots.save_view(spark, "SELECT order_id FROM later_orders", "later_view")
        assert ids(spark.table("later_view")) == ["A"]
        # Published as another process would, without touching this session's views.
        snapshots.table(spark, "later_orders").write(rows, ("year", "month"))
        assert ids(spark.table("later_view")) == ["A", "B"]

    def test_an_empty_partitioned_table_in_a_schema(self, spark, raw):
        rows = orders_etl.staged_orders(raw({})).where(F.lit(False))
        snapshots.save_table(rows, "gold.none_yet", ("year", "month"))
        assert spark.table("gold.none_yet").dtypes == rows.dtypes and spark.table("gold.none_yet").count() == 0
        snapshots.save_table(orders_etl.staged_orders(raw({})), "gold.none_yet", ("year", "month"))
        assert spark.table("gold.none_yet").count() == 1

    def test_a_rejected_load_leaves_no_files(self, spark, raw):
        snapshots.replace_snapshot(raw({"order_id": "OLD"}), "orders_clean", "order_id")
        before = parts(snapshots.table(spark, "orders_clean"))
        with pytest.raises(snapshots.SnapshotRejected):
            snapshots.replace_snapshot(raw({"order_id": "A"}, {"order_id": "A"}), "orders_clean", "order_id")
        assert parts(snapshots.table(spark, "orders_clean")) == before

    def test_newest_load_time_is_reported(self, spark, raw):
        done = snapshots.replace_snapshot(orders_etl.staged_orders(raw({})), "orders_timed", "order_id", (), "etl_loaded_at")
        assert isinstance(done.latest_load, dt.datetime)


class TestStagedMonths:
    DAYS = ({"order_id": "A"}, {"order_id": "B", "order_date": "2023-12-31"}, {"order_id": "C", "order_date": "2024-01-02"})

    def test_a_month_is_replaced_alone(self, spark, raw, tmp_path):
        path = str(tmp_path / "staged")
        write_staged(orders_etl.staged_orders(raw(*self.DAYS)), path)
        before = files(path)
        again = orders_etl.staged_orders(raw({"order_id": "A2"}, *self.DAYS))
        assert write_staged(again, path, [(2024, 3)]) == 2
        assert ids(read_staged(spark, path)) == ["A", "A2", "B", "C"]
        new = set(files(path)) - set(before)
        assert new and all("year=2024/month=3/" in f for f in new)
        assert {f: t for f, t in files(path).items() if f in before} == before
        # A month without orders leaves the set; what isn't named stays.
        assert write_staged(again.where("month <> 12"), path, [(2023, 12)]) == 0
        assert ids(read_staged(spark, path)) == ["A", "A2", "C"]

    def test_months_that_were_replaced_are_collected(self, spark, raw, tmp_path):
        path = str(tmp_path / "staged")
        rows = orders_etl.staged_orders(raw(*self.DAYS))
        write_staged(rows, path)
        for _ in range(KEPT_COMMITS):
            write_staged(rows, path, [(2024, 3)])
        months = [f.split("/data/")[1].split("/", 1)[1].rpartition("/")[0] for f in files(path)]
        assert sorted(months) == sorted(["year=2023/month=12", "year=2024/month=1", *["year=2024/month=3"] * KEPT_COMMITS])

    def test_a_run_that_dies_leaves_the_old_set(self, spark, raw, tmp_path):
        path = str(tmp_path / "staged")
        write_staged(orders_etl.staged_orders(raw(*self.DAYS)), path)
        code = f"""
            import os
            from pyspark.sql import functions as F
            from tillstar.session import local_session
            from tillstar.sources import commits
            from tillstar.sources.staging_area import read_staged, write_staged
            spark = local_session(1, "1g")
            commits.CommittedTable._publish = lambda *_: os._exit(9)
            write_staged(read_staged(spark, {path!r}).withColumn("order_id", F.lit("half")), {path!r})
        """
        done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], env=os.environ | {"PYTHONPATH": ROOT}, cwd=tmp_path, capture_output=True, text=True)
        assert done.returncode == 9, done.stderr[-2000:]
        assert len(parts(CommittedTable(spark, path))) == 2
        assert ids(read_staged(spark, path)) == ["A", "B", "C"]
        write_staged(orders_etl.staged_orders(raw({"order_id": "N"})), path)
        assert ids(read_staged(spark, path)) == ["N"] and len(parts(CommittedTable(spark, path))) == 2


class TestHistoryParts:
    RUNS = [dt.datetime(2024, m, 1) for m in range(1, 6)]

    def customers(self, spark, spends):
        rows = [(f"K{i}", f"C{i}", "IN", None, None, 1, float(s), float(s), "gold", "low") for i, s in spends.items()]
        types = "customer_key string, customer_id string, country_code string, first_order_date date, last_order_date date, total_orders int, "
        return spark.createDataFrame(rows, types + "total_spend double, avg_order_value double, customer_segment string, churn_risk string")

    def test_a_run_adds_open_and_changed_versions_only(self, spark, table):
        spends = dict.fromkeys(range(50), 1)
        written = []
        for i, at in enumerate(self.RUNS):
            before = set(files(table.root))
            spends = {k: v + (k < 3 and i > 0) for k, v in spends.items()}
            done = customer_history.record_run(table, self.customers(spark, spends), at)
            new = set(files(table.root)) - before
            written.append(sum(spark.read.parquet(f).count() for f in new))
            assert {f.split("_state=")[1].split("/")[0] for f in new} == ({"open", "closed"} if i else {"open"})
        # Fifty open versions each time, and three that the run closed; earlier closed ones are never written again.
        assert written == [50, 53, 53, 53, 53]
        assert done.rows == table.read().count() == 50 + 4 * 3
        assert table.read().where(F.col(VALID_TO).isNull()).count() == 50
        closed = [f for f in table.latest().folders if f.endswith("closed")]
        assert len(closed) == 4 and customer_history.STATE not in table.read().columns

    def test_runs_go_forward(self, spark, table):
        customer_history.record_run(table, self.customers(spark, {1: 1}), self.RUNS[1])
        for at in self.RUNS[:2]:
            with pytest.raises(ValueError, match="can't follow"):
                customer_history.record_run(table, self.customers(spark, {1: 2}), at)
        assert table.read().count() == 1
