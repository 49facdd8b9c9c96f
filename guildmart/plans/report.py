"""The customer report: one row per customer and calendar month.

Three aggregations of the order lines make it: sums per category, orders per craftsman and the
median of the days to completion. Each combines rows before its shuffle, and categories and
craftsmen are spread over tasks by their own key too before the best is taken, so a customer and
month holding a third of all orders is no hot spot. The median keeps one counter per distinct number
of days, which the calendar bounds. The three meet on (customer, month), by which their results are
already partitioned, and customers join last, on rows that are aggregated.

Orders must satisfy their foreign keys (``operators.quality.orphans`` finds those that do not).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from guildmart.functions import commission, days_between, mean_price, money, month_of, whole_years
from guildmart.operators.sizing import is_small, unless_large
from guildmart.schemas import CUSTOMERS_TABLE, REPORT, conform

# The order states that are counted one by one.
STATUSES = {
    "count_order_created": "created",
    "count_order_in_progress": "in progress",
    "count_order_delivery": "delivery",
    "count_order_done": "done",
}
DONE = "done"

GROUP = ("customer_id", "report_period")
# Products of more bytes are not broadcast, however few of their columns a plan reads in the end.
PRODUCT_BYTES = 256 * 1024 * 1024


def order_months(orders: DataFrame) -> DataFrame:
    """Orders with their month and days to completion."""
    return orders.select(
        "customer_id",
        "craftsman_id",
        "product_id",
        "order_id",
        "order_status",
        month_of(F.col("order_created_date")).alias("report_period"),
        days_between(F.col("order_created_date"), F.col("order_completion_date")).alias("days"),
    )


def order_lines(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with month, days to completion, price and category; nothing else is carried on."""
    priced = products.select("product_id", "product_type", "product_price")
    return order_months(orders).join(unless_large(priced, PRODUCT_BYTES), "product_id")


def status_sums() -> list[Column]:
    status = F.col("order_status")
    flags = {name: status == value for name, value in STATUSES.items()}
    flags["count_order_not_done"] = status != DONE
    return [F.sum(F.when(flag, 1).otherwise(0)).alias(name) for name, flag in flags.items()]


def sums() -> list[Column]:
    return [
        F.sum("product_price").alias("total"),
        F.count("product_price").alias("priced"),
        F.count("order_id").alias("count_order"),
        *status_sums(),
    ]


def price_columns() -> dict[str, Column]:
    return {
        "customer_money": money(F.col("total")),
        "platform_money": commission(F.col("total")),
        "avg_price_order": mean_price(F.col("total"), F.col("priced")),
    }


def report_measures(lines: DataFrame) -> DataFrame:
    """Money and order counts per customer and month."""
    counts = ["count_order", *STATUSES, "count_order_not_done"]
    return (
        lines.groupBy(*GROUP)
        .agg(*sums())
        .select(*GROUP, *(c.alias(n) for n, c in price_columns().items()), *counts)
    )


def status_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*GROUP).agg(*status_sums())


def median_days() -> Column:
    """Exact median of the days to completion; NULL where every order is open."""
    return F.median("days").cast("decimal(10,1)").alias("median_time_order_completed")


def median_completion(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*GROUP).agg(median_days())


def category_counts(lines: DataFrame, *group: str) -> DataFrame:
    """Orders per category within each customer (by default) or any coarser or finer group."""
    by = group or ("customer_id",)
    return lines.groupBy(*by, "product_type").agg(F.count("product_id").alias("count_product"))


def craftsman_counts(lines: DataFrame, *group: str) -> DataFrame:
    by = group or ("customer_id",)
    return lines.groupBy(*by, "craftsman_id").agg(F.count("order_id").alias("count_product"))


def top_category(lines: DataFrame) -> DataFrame:
    """Most ordered category per customer and month, the alphabetically first of equals."""
    counts = category_counts(lines, *GROUP)
    order = W.partitionBy(*GROUP).orderBy(F.desc("count_product"), "product_type")
    return _best(counts, order, "product_type", "top_product_category")


def top_craftsman(lines: DataFrame) -> DataFrame:
    """Craftsman with most orders per customer and month, the smallest id of equals."""
    counts = craftsman_counts(lines, *GROUP)
    order = W.partitionBy(*GROUP).orderBy(F.desc("count_product"), "craftsman_id")
    return _best(counts, order, "craftsman_id", "top_craftsman")


def _best(counts: DataFrame, order: W, value: str, name: str) -> DataFrame:
    return (
        counts.withColumn("_n", F.row_number().over(order))
        .filter("_n = 1")
        .select(*GROUP, F.col(value).alias(name), "count_product")
    )


def top_categories_as_written(lines: DataFrame) -> DataFrame:
    """Every category tied for first place over all months of a customer."""
    order = W.partitionBy("customer_id").orderBy(F.desc("count_product"))
    return (
        category_counts(lines)
        .withColumn("rank_count_product", F.rank().over(order))
        .filter("rank_count_product = 1")
        .drop("rank_count_product")
    )


def top_craftsmen_as_written(lines: DataFrame) -> DataFrame:
    """Every craftsman of a customer: ranking within (customer, craftsman) keeps them all."""
    return craftsman_counts(lines)


def report_as_written(lines: DataFrame, customers: DataFrame, as_of: date | str) -> DataFrame:
    """Report rows, without top entries, next to the number of rows the literal SQL repeats them in.

    Read literally, each row repeats once per tied category and craftsman of the customer. That
    product is counted here and not spelled out; its two factors are the frames above.
    """
    ties = top_categories_as_written(lines).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("tied_categories"),
        F.min("product_type").alias("first_category"),
    )
    masters = top_craftsmen_as_written(lines).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("craftsmen"), F.min("craftsman_id").alias("first_craftsman")
    )
    median = median_completion(lines.filter(F.col("days").isNotNull()))
    return (
        report_measures(lines)
        .join(median, list(GROUP), "left")
        .join(_people(customers, as_of), "customer_id")
        .join(ties, "customer_id")
        .join(masters, "customer_id")
        .withColumn("written_rows", F.col("tied_categories") * F.col("craftsmen"))
    )


def monthly_figures(orders: DataFrame, products: DataFrame) -> DataFrame:
    """All figures per customer and month: measures, median and the two top entries.

    Sums are taken per category first, from which both the totals and the top category follow, so
    that orders meet products once. Median and craftsman need no product. Both join as aggregates by the
    group, one row each, so that whoever wants neither does not shuffle orders for them.
    """
    totals = ["total", "priced", "count_order", *STATUSES, "count_order_not_done"]
    most_ordered = F.min(F.struct(-F.col("count_order"), F.col("product_type").alias("value")))
    measures = (
        order_lines(orders, products)
        .groupBy(*GROUP, "product_type")
        .agg(*sums())
        .groupBy(*GROUP)
        .agg(*(F.sum(c).alias(c) for c in totals), most_ordered.alias("_most_ordered"))
        .withColumns({**price_columns(), "top_product_category": F.col("_most_ordered.value")})
        .dropna(subset=list(GROUP))
    )
    months = order_months(orders)
    craftsman = top_craftsman(months).groupBy(*GROUP).agg(F.min("top_craftsman").alias("top_craftsman"))
    median = median_completion(months.filter(F.col("days").isNotNull()))
    return measures.join(craftsman, list(GROUP), "left").join(median, list(GROUP), "left")


def with_customers(figures: DataFrame, customers: DataFrame, as_of: date | str) -> DataFrame:
    """Report rows: monthly figures and the attributes of their customer, aged at ``as_of``."""
    return conform(figures.join(_people(customers, as_of), "customer_id"), REPORT)


def _people(customers: DataFrame, as_of: date | str) -> DataFrame:
    age = _age(as_of).cast(REPORT["avg_age_customer"].dataType.simpleString())
    return customers.select(
        CUSTOMERS_TABLE.id_col, *CUSTOMERS_TABLE.source_cols, age.alias("avg_age_customer")
    )


def _age(as_of: date | str) -> Column:
    return whole_years(F.col("customer_birthday"), F.lit(str(as_of)).cast("date"))


def aged(report: DataFrame, as_of: date | str) -> DataFrame:
    """Report rows with their customer's age at ``as_of``: a projection, as the birthday is in the row."""
    kept = report.schema["avg_age_customer"].dataType.simpleString()
    return report.withColumn("avg_age_customer", _age(as_of).cast(kept))


def customer_report(
    orders: DataFrame, products: DataFrame, customers: DataFrame, as_of: date | str
) -> DataFrame:
    """The report over all given orders."""
    return with_customers(monthly_figures(orders, products), customers, as_of)


def customer_report_for(
    touched: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    as_of: date | str,
) -> DataFrame:
    """Report rows of the touched (customer, month) pairs, from all of their orders.

    Few pairs are broadcast and pick their orders out of the scan. Many are matched after the
    aggregation instead, where keys are unique: shuffling raw orders to them would bring a hot
    customer's orders into one task.
    """
    wanted = touched.select(*GROUP)
    if is_small(wanted):
        theirs = (
            orders.withColumn("report_period", month_of(F.col("order_created_date")))
            .join(F.broadcast(wanted), list(GROUP), "left_semi")
            .drop("report_period")
        )
        return customer_report(theirs, products, customers, as_of)
    figures = monthly_figures(orders, products).join(wanted, list(GROUP), "left_semi")
    return with_customers(figures, customers, as_of)
