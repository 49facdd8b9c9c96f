"""Run loads from the command line, e.g. ``spark-submit guildmart/__main__.py increment ...``."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from guildmart.operators.upsert import ERROR, POLICIES  # noqa: E402
from guildmart.plans.loads import Policy, increment, rebuild, refresh_report  # noqa: E402
from guildmart.sources.feeds import read_customers_feed, read_orders_feed  # noqa: E402
from guildmart.sources.warehouse import Warehouse  # noqa: E402


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="guildmart")
    parser.add_argument("command", choices=["increment", "refresh", "rebuild"])
    parser.add_argument("--warehouse", required=True, help="folder of the tables")
    parser.add_argument("--orders", help="orders feed (increment)")
    parser.add_argument("--customers", help="customers feed (increment)")
    parser.add_argument("--format", default="parquet", help="file format of the feeds")
    parser.add_argument("--load-ts", help="stamp of changed rows; now by default")
    parser.add_argument("--as-of", help="day at which ages are counted; that of the stamp")
    parser.add_argument("--on-conflict", choices=POLICIES, default=ERROR)
    parser.add_argument("--order-by", nargs="+", default=["id"], help="columns that tell the latest row")
    parser.add_argument("--only-if-changed", action=argparse.BooleanOptionalAction, default=True)
    parser.add_argument("--lenient", action="store_true", help="leave incomplete rows out")
    chosen = parser.parse_args(argv)
    if chosen.command == "increment" and not (chosen.orders and chosen.customers):
        parser.error("increment needs --orders and --customers")
    return chosen


def main(argv: list[str] | None = None) -> None:
    chosen = arguments(argv)
    spark = SparkSession.builder.appName(f"guildmart {chosen.command}").getOrCreate()
    warehouse = Warehouse(spark, chosen.warehouse).create()
    policy = Policy(chosen.on_conflict, chosen.only_if_changed, not chosen.lenient, tuple(chosen.order_by))
    if chosen.command == "increment":
        orders = read_orders_feed(spark, chosen.orders, chosen.format)
        customers = read_customers_feed(spark, chosen.customers, chosen.format)
        increment(warehouse, orders, customers, chosen.load_ts, chosen.as_of, policy)
    else:
        run = rebuild if chosen.command == "rebuild" else refresh_report
        run(warehouse, chosen.load_ts, chosen.as_of, policy)


if __name__ == "__main__":
    main()
