"""The two input feeds: read from storage, or derived from the order-line test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guildmart.operators.sizing import is_small
from guildmart.operators.spread import join_dealt
from guildmart.schemas import CUSTOMERS_FEED, ORDERS_FEED, conform
from guildmart.sources.shared import written


def read_orders_feed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(ORDERS_FEED).load(path)


def read_customers_feed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(CUSTOMERS_FEED).load(path)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _placed(spark: SparkSession, sf_dir: str, rows: DataFrame, nation_key: str) -> DataFrame:
    """Add nation and region, each a fixed few rows, one after the other."""
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    return rows.join(nation, rows[nation_key] == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )


def _text(column: str) -> F.Column:
    return F.col(column).cast("string")


def derived_customers_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers feed made from customer, nation and region."""
    key = F.col("c_custkey")
    building = (key % 97 + 1).cast("string")
    people = _placed(spark, sf_dir, _table(spark, sf_dir, "customer"), "c_nationkey")
    feed = people.select(
        key.alias("customer_id"),
        F.concat_ws(" ", "c_mktsegment", "c_name").alias("customer_name"),
        F.concat(building, F.lit(" "), F.col("r_name"), F.lit(" Street "), _text("c_nationkey"))
        .alias("customer_address"),
        F.date_add(F.lit("1950-01-01").cast("date"), (key * 37 % 18000).cast("int"))
        .alias("customer_birthday"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("customer_email"),
    )
    return conform(feed, CUSTOMERS_FEED)


def _craftsman() -> list[F.Column]:
    key = F.col("s_suppkey")
    building = (key % 89 + 1).cast("string")
    return [
        key.alias("craftsman_id"),
        F.concat(F.lit("Master "), "s_name").alias("craftsman_name"),
        F.concat(building, F.lit(" "), "r_name", F.lit(" Lane")).alias("craftsman_address"),
        F.date_add(F.lit("1950-01-01").cast("date"), (key * 41 % 15000).cast("int"))
        .alias("craftsman_birthday"),
        F.concat(F.lower("s_name"), F.lit("@example.com")).alias("craftsman_email"),
    ]


def derived_craftsmen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The craftsmen of the orders feed made from supplier, nation and region, each once."""
    suppliers = _placed(spark, sf_dir, _table(spark, sf_dir, "supplier"), "s_nationkey")
    return suppliers.select(*_craftsman())


def _ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and their orders, both of any size, with the columns that the feed is made of."""
    lines, orders = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders")
    wanted = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *wanted, "o_custkey", "o_orderdate", "o_orderstatus"
    )


def _order() -> list[Column]:
    """The feed's columns that lines and orders hold."""
    ordered = F.col("o_orderdate").cast("date")
    finished = F.date_add(ordered, (F.col("l_orderkey") % 11 + F.col("l_linenumber")).cast("int"))
    status = (
        F.when(F.col("o_orderstatus") == "F", "done")
        .when(F.col("o_orderstatus") == "P", "delivery")
        .when(F.col("l_linestatus") == "O", "created")
        .otherwise("in progress")
    )
    return [
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        ordered.alias("order_created_date"),
        F.when(F.col("o_orderstatus") == "F", finished).alias("order_completion_date"),
        status.alias("order_status"),
        F.col("o_custkey").alias("customer_id"),
    ]


def derived_orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders feed made from lineitem, orders, part, supplier, nation and region.

    Lines and their orders are joined once and written, however often the feed is read; without the
    texts, which come from the smaller tables at each reading.
    """
    lines = (
        written(_ordered_lines(spark, sf_dir))
        .join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(_table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    feed = (
        _placed(spark, sf_dir, lines, "s_nationkey")
        .select(
            *_order(),
            *_craftsman(),
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("product_description"),
            F.col("p_type").alias("product_type"),
            F.round(F.col("p_retailprice") * 10).cast("bigint").alias("product_price"),
        )
    )
    return conform(feed, ORDERS_FEED)


def derived_order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the same feed that are no texts, its lines joined with all six tables.

    Meant to be written: of part and supplier only keys are needed, so that the optimizer takes them for
    small from the size of their files. Here they are measured; many meet the lines in a shuffle.
    """
    parts = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"))
    suppliers = _placed(spark, sf_dir, _table(spark, sf_dir, "supplier"), "s_nationkey")
    lines = _ordered_lines(spark, sf_dir)
    for known, key in ((parts, "l_partkey"), (suppliers.select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey")):
        lines = lines.join(F.broadcast(known), key) if is_small(known) else join_dealt(written(lines), known, [key])
    ids = F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("craftsman_id")
    return lines.select(*_order(), *ids)
