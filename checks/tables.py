"""Warehouse tables derived from the test tables, under the feeds' own ids.

They are what the report and delta queries read. Load stamps follow from the data: what carries
``SECOND_LOAD`` is what a second load would have brought.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guildmart.operators.staging import split_person
from guildmart.operators.upsert import load_stamp
from guildmart.schemas import CRAFTSMEN, CUSTOMERS, ORDERS, PRODUCTS, conform
from guildmart.sources.feeds import (
    derived_craftsmen,
    derived_customers_feed,
    derived_order_ids,
    derived_orders_feed,
)
from guildmart.sources.shared import written

FIRST_LOAD = "2024-01-01 00:00:00"
SECOND_LOAD = "2024-01-02 00:00:00"
THIRD_LOAD = "2024-01-03 00:00:00"
AS_OF = "2024-01-01"
SPLIT_DAY = "2001-01-01"


def _stamped(late: Column) -> Column:
    return F.when(late, load_stamp(SECOND_LOAD)).otherwise(load_stamp(FIRST_LOAD))


@dataclass(frozen=True)
class Star:
    orders: DataFrame
    products: DataFrame
    craftsmen: DataFrame
    customers: DataFrame

    def dims(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.products, self.craftsmen, self.customers


def feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return derived_orders_feed(spark, sf_dir), derived_customers_feed(spark, sf_dir)


def first_batch() -> Column:
    return F.col("order_created_date") < F.lit(SPLIT_DAY).cast("date")


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The tables; orders, which are read many times, are written."""
    customers_feed = derived_customers_feed(spark, sf_dir)
    late = ~first_batch() | (F.col("order_status") == "created")
    lines = derived_order_ids(spark, sf_dir)
    orders = lines.withColumns({"order_id": F.col("id"), "load_dttm": _stamped(late)})
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    products = part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("product_description"),
        F.col("p_type").alias("product_type"),
        F.round(F.col("p_retailprice") * 10).cast("bigint").alias("product_price"),
        _stamped(F.col("p_size") > 48).alias("load_dttm"),
    )
    craftsmen = split_person(derived_craftsmen(spark, sf_dir), "craftsman").withColumn(
        "load_dttm", _stamped(F.col("craftsman_address_building") == 7)
    )
    customers = split_person(customers_feed, "customer").withColumn(
        "load_dttm", _stamped(F.col("customer_address_street").startswith("ASIA"))
    )
    return Star(
        written(conform(orders, ORDERS)),
        conform(products, PRODUCTS),
        conform(craftsmen, CRAFTSMEN),
        conform(customers, CUSTOMERS),
    )
