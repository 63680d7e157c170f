"""Command line: ``python -m tillstar JOB ...`` or the same under ``spark-submit``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from tillstar import jobs
from tillstar.session import builder


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tillstar")
    commands = parser.add_subparsers(dest="job", required=True)
    generate = commands.add_parser("generate", help="write a synthetic feed with noise")
    generate.add_argument("feed")
    generate.add_argument("--rows", type=int, default=1_000_000)
    generate.add_argument("--seed", type=int, default=42)
    stage = commands.add_parser("stage", help="clean a CSV feed into staged Parquet")
    stage.add_argument("feed")
    stage.add_argument("staged")
    stage.add_argument("--month", type=lambda m: tuple(map(int, m.split("-"))), action="append", metavar="YYYY-MM", help="replace only these months")
    check = commands.add_parser("check", help="run the quality gate; exit code 1 when it stays closed")
    check.add_argument("staged")
    check.add_argument("--volume", type=int, nargs=2, default=None, metavar=("LOW", "HIGH"))
    load = commands.add_parser("load", help="publish the staged set as the orders snapshot")
    load.add_argument("staged")
    load.add_argument("--target", default=None)
    load.add_argument("--on-error", choices=("abort", "continue"), default="abort", help="continue: append new files, rejected rows aside")
    verify = commands.add_parser("verify", help="figures and age of the published orders; exit code 1 when they are too old")
    verify.add_argument("--target", default="orders")
    marts = commands.add_parser("marts", help="build the star schema, test it and write the reports")
    marts.add_argument("--orders", default="orders")
    marts.add_argument("--schema", default=None)
    marts.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    history = commands.add_parser("history", help="continue the customer history with the published dimension")
    history.add_argument("run_at", type=dt.datetime.fromisoformat)
    history.add_argument("--schema", default=None)
    options = parser.parse_args(arguments)

    spark = builder().getOrCreate()
    if options.job == "stage":
        print(jobs.stage(spark, options.feed, options.staged, options.month))
    elif options.job == "generate":
        jobs.generate(spark, options.feed, options.rows, options.seed)
    elif options.job == "verify":
        figures, age = jobs.verify(spark, options.target)
        print(figures)
        print(age)
        return int(age["status"] == "error")
    elif options.job == "load" and options.on_error == "continue":
        print(jobs.load_tolerant(spark, options.staged, options.target or "loaded_files"))
    elif options.job == "check":
        bounds = {"volume": tuple(options.volume)} if options.volume else {}
        try:
            for line in jobs.check(spark, options.staged, **bounds):
                print("pass" if line["success"] else line["severity"], line["name"], line["invalid_count"])
        except jobs.GateClosed as closed:
            print(f"quality gate closed: {closed}", file=sys.stderr)
            return 1
    elif options.job == "load":
        print(jobs.load(spark, options.staged, options.target or "orders"))
    elif options.job == "history":
        print(jobs.record_history(spark, options.run_at, options.schema))
    else:
        jobs.build_marts(spark, options.orders, options.schema, options.as_of)
        failed = jobs.run_declared_tests(spark, options.orders, options.schema).where("failures > 0").collect()
        for line in failed:
            print(line["status"], line["table_name"], line["column_name"], line["test"], line["failures"])
        for name, location in jobs.publish_reports(spark, options.orders, options.schema, options.as_of).items():
            print(name, location)
        return int(any(line["status"] == "error" for line in failed))
    return 0


if __name__ == "__main__":
    sys.exit(main())
