"""What changed since the last load: the load mark, the changed orders and the months they touch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guildmart.functions import month_of
from guildmart.operators.sizing import broadcast_small
from guildmart.operators.upsert import load_stamp

# Fixed value: the mark of a warehouse that was never loaded.
NEVER = "1900-01-01 00:00:00"

PAIR = ("customer_id", "report_period")
STAMPS = ("orders_load_dttm", "products_load_dttm", "craftsmen_load_dttm", "customers_load_dttm")


def read_mark(load_log: DataFrame) -> DataFrame:
    """One row: the latest load, or 1900-01-01 from an empty log."""
    latest = F.coalesce(F.max("load_dttm"), load_stamp(NEVER))
    return load_log.agg(latest.alias("load_dttm"))


def changed_orders(
    orders: DataFrame,
    products: DataFrame,
    craftsmen: DataFrame,
    customers: DataFrame,
    mark: Column,
) -> DataFrame:
    """Orders loaded after ``mark``, or whose product, craftsman or customer was.

    An OR over four tables cannot be pushed below their join. Here each table is filtered by its
    own stamp first, so only ids of changed dimension rows meet the orders, which are read once.
    The stamps of unchanged dimension rows come out NULL.
    """
    newer = F.col("load_dttm") > mark
    lines = orders.select(
        "order_id",
        "product_id",
        "craftsman_id",
        "customer_id",
        month_of(F.col("order_created_date")).alias("report_period"),
        F.col("load_dttm").alias("orders_load_dttm"),
    )
    for name, dim, id_col in (
        ("products", products, "product_id"),
        ("craftsmen", craftsmen, "craftsman_id"),
        ("customers", customers, "customer_id"),
    ):
        news = dim.filter(newer).select(id_col, F.col("load_dttm").alias(f"{name}_load_dttm"))
        lines = lines.join(news, id_col, "left")
    changed = F.col("orders_load_dttm") > mark
    for stamp in STAMPS[1:]:
        changed = changed | F.col(stamp).isNotNull()
    return lines.filter(changed)


def touched_months(
    orders: DataFrame,
    products: DataFrame,
    craftsmen: DataFrame,
    customers: DataFrame,
    report: DataFrame,
    mark: Column,
    recent: DataFrame | None = None,
) -> DataFrame:
    """The (customer, month) pairs of all changed orders, with the newest stamps seen in each.

    Same pairs as in ``changed_orders``, but orders never meet customers: the months of a customer
    whose attributes changed are in the report already, or are touched by a new order.

    Each reason is a branch of its own, so that newer orders are found by a filter that reaches the
    scan, and orders meet changed products or craftsmen in inner joins, which runtime filters prune.
    Without changed products and craftsmen the other orders are not read at all. ``recent``, if
    given, are the orders that can be newer than ``mark``.
    """
    newer = F.col("load_dttm") > mark
    month = month_of(F.col("order_created_date")).alias("report_period")
    stamp = F.col("load_dttm")
    fresh = (orders if recent is None else recent).filter(newer)
    branches = [fresh.select("customer_id", month, stamp.alias("orders_load_dttm"))]
    for name, dim, id_col in (
        ("craftsmen", craftsmen, "craftsman_id"),
        ("products", products, "product_id"),
    ):
        news = dim.filter(newer).select(id_col, stamp.alias(f"{name}_load_dttm"))
        if not news.isEmpty():
            lines = orders.select("customer_id", id_col, month).join(broadcast_small(news), id_col)
            branches.append(lines.drop(id_col))
    renewed = customers.filter(newer).select("customer_id", stamp.alias("customers_load_dttm"))
    branches.append(report.select(*PAIR).join(broadcast_small(renewed), "customer_id"))
    touched = branches[0]
    for branch in branches[1:]:
        touched = touched.unionByName(branch, allowMissingColumns=True)
    for name in STAMPS:
        if name not in touched.columns:
            touched = touched.withColumn(name, F.lit(None).cast("timestamp_ntz"))
    return touched.groupBy(*PAIR).agg(*(F.max(name).alias(name) for name in STAMPS))


def new_customers(delta: DataFrame, report: DataFrame) -> DataFrame:
    """Changed customers without any report row."""
    return _customers(delta).join(report.select("customer_id"), "customer_id", "left_anti")


def existing_customers(delta: DataFrame, report: DataFrame) -> DataFrame:
    """Changed customers that are in the report already, each once."""
    return _customers(delta).join(report.select("customer_id"), "customer_id", "left_semi")


def _customers(delta: DataFrame) -> DataFrame:
    return delta.select("customer_id").distinct()


def orders_of(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """All orders of the listed customers. A semi-join, so a repeated key multiplies nothing."""
    return orders.join(customers.select("customer_id"), "customer_id", "left_semi")


def next_mark(delta: DataFrame, load_ts: datetime | str) -> DataFrame:
    """One row: the newest stamp in the delta, or this run's stamp if nothing changed."""
    newest = F.greatest(*(F.max(stamp) for stamp in STAMPS))
    return delta.agg(F.coalesce(newest, load_stamp(load_ts)).alias("load_dttm"))
