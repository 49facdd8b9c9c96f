"""Small hand-written feeds and tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from guildmart.schemas import CUSTOMERS, CUSTOMERS_FEED, ORDERS, ORDERS_FEED, PRODUCTS

STAMP = datetime(2024, 1, 1)
LATER = datetime(2024, 1, 2)


def order_feed_row(n: int, **changes) -> tuple:
    row = {
        "id": n,
        "craftsman_id": 1,
        "craftsman_name": "Carl Smith",
        "craftsman_address": "7 Forge Lane",
        "craftsman_birthday": date(1970, 5, 1),
        "craftsman_email": "carl@example.com",
        "product_id": n,
        "product_name": f"product {n}",
        "product_description": "made by hand",
        "product_type": "toys",
        "product_price": 100 + n,
        "order_id": n,
        "order_created_date": date(2023, 1, 1 + n % 28),
        "order_completion_date": None,
        "order_status": "created",
        "customer_id": 1,
    }
    row.update(changes)
    return tuple(row[name] for name in ORDERS_FEED.names)


def orders_feed(spark: SparkSession, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), ORDERS_FEED)


def customers_feed(spark: SparkSession, *people: tuple) -> DataFrame:
    """People as (id, name, address)."""
    rows = [
        (n, name, address, date(1980, 1, n), f"c{n}@example.com") for n, name, address in people
    ]
    return spark.createDataFrame(rows, CUSTOMERS_FEED)


ANN = (1, "Ann Lee", "12 Main St")
BOB = (2, "Bob Ray", "14 Oak Road")


def orders(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Orders as (product, craftsman, customer, created, completed, status)."""
    return spark.createDataFrame(
        [(n, *row, STAMP) for n, row in enumerate(rows, start=1)], ORDERS
    )


def products(spark: SparkSession, prices: dict[int, tuple[str, int]]) -> DataFrame:
    """Products as id -> (type, price)."""
    rows = [(n, f"p{n}", "made by hand", kind, price, STAMP) for n, (kind, price) in prices.items()]
    return spark.createDataFrame(rows, PRODUCTS)


def customers(spark: SparkSession, *ids: int) -> DataFrame:
    rows = [
        (n, f"name{n}", f"surname{n}", n, "Main St", date(1980, 1, 1), f"c{n}@example.com", STAMP)
        for n in ids
    ]
    return spark.createDataFrame(rows, CUSTOMERS)
