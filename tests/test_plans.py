"""The shapes of physical plans that have to hold at any size."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from checks.tables import AS_OF, star
from guildmart.operators.upsert import load_stamp, merge_single
from guildmart.plans import report as R
from guildmart.plans.loads import increment
from guildmart.schemas import ORDERS_TABLE
from guildmart.sources.warehouse import Warehouse
from tests.samples import ANN, customers_feed, order_feed_row, orders_feed


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for tables that are all too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "increment_two_batches"])
def test_no_pairs_no_python_and_no_single_partition_window(spark, sf_dir, no_broadcast, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text
    # an exchange to a single partition may carry a global aggregate's partial rows, no window
    for window in re.finditer(r"Window \[.*", text):
        assert "windowspecdefinition(" in window.group()
        assert not re.search(r"windowspecdefinition\(\s*[\w#]+ (ASC|DESC)", window.group())


def test_tops_are_limited_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["top_craftsman"](spark, sf_dir))
    assert len(re.findall(r"WindowGroupLimit .*Partial", text)) == 1
    assert len(re.findall(r"WindowGroupLimit .*Final", text)) == 1


def test_report_combines_before_every_shuffle_on_its_group(spark, sf_dir, no_broadcast):
    text = plan(QUERIES["report_full"](spark, sf_dir))
    lines = text.splitlines()
    grouped = [
        n for n, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\(customer_id#\d+L, report_period", line)
    ]
    assert grouped
    for n in grouped:
        below = " ".join(lines[n + 1 : n + 4])
        assert "partial_" in below or "WindowGroupLimit" in below


def test_many_touched_months_meet_aggregated_rows_only(spark, sf_dir, no_broadcast, monkeypatch):
    monkeypatch.setattr(R, "is_small", lambda frame: False)
    tables = star(spark, sf_dir)
    touched = R.order_months(tables.orders).select(*R.GROUP).distinct()
    frame = R.customer_report_for(
        touched, tables.orders, tables.products, tables.customers, AS_OF
    )
    text = plan(frame)
    semi = text[text.index("LeftSemi") :]
    assert "partial_" in semi.split("FileScan")[0]


def test_few_touched_months_need_no_shuffle_of_orders(spark, sf_dir, no_broadcast):
    tables = star(spark, sf_dir)
    touched = R.order_months(tables.orders).select(*R.GROUP).distinct()
    frame = R.customer_report_for(
        touched, tables.orders, tables.products, tables.customers, AS_OF
    )
    assert re.search(r"BroadcastHashJoin .*LeftSemi", plan(frame))


def test_scans_read_needed_columns_only(spark, sf_dir):
    text = plan(QUERIES["craftsman_counts"](spark, sf_dir))
    assert "o_totalprice" not in text and "l_extendedprice" not in text
    text = plan(QUERIES["report_full"](spark, sf_dir))
    assert "p_size" not in text and "s_name" not in text


def test_dimension_stamps_are_filtered_in_the_scan(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w")).create()
    increment(
        warehouse,
        orders_feed(spark, order_feed_row(1)),
        customers_feed(spark, ANN),
        "2024-01-01 00:00:00",
        AS_OF,
    )
    tables = warehouse.tables()
    newer = tables["products"].filter(F.col("load_dttm") > load_stamp("2023-01-01 00:00:00"))
    assert "GreaterThan(load_dttm" in plan(newer)
    month = warehouse.read(ORDERS_TABLE, warehouse.snapshot(), ["2023-01"])
    assert month.inputFiles() and all("order_month=2023-01" in f for f in month.inputFiles())
    assert warehouse.read(ORDERS_TABLE, warehouse.snapshot(), ["2023-02"]).count() == 0


def test_small_news_leave_the_target_where_it_is(spark, sf_dir, no_broadcast):
    target = star(spark, sf_dir).orders
    rows = target.select(*ORDERS_TABLE.source_cols)
    frame = merge_single(
        target, rows, ORDERS_TABLE, "2024-01-02 00:00:00", start=F.lit(0).cast("bigint"), small=True
    )
    text = plan(frame)
    assert not re.search(r"Exchange hashpartitioning\(product_id#\d+L, craftsman_id#\d+L, cust", text)


def test_the_report_before_is_computed_once(spark, sf_dir):
    """As the target and for the months that are touched."""
    medians = plan(QUERIES["report_full"](spark, sf_dir)).count("percentile(")
    assert medians and plan(QUERIES["datamart_update_existing"](spark, sf_dir)).count("percentile(") == medians


def test_new_rows_are_found_by_one_report_before(spark, sf_dir):
    """Its pairs are written, for the months that are touched and as the target."""
    tops = plan(QUERIES["report_full"](spark, sf_dir)).count("WindowGroupLimit")
    assert tops and plan(QUERIES["datamart_insert_new"](spark, sf_dir)).count("WindowGroupLimit") == tops


def test_pairs_of_the_report_count_no_craftsmen(spark, sf_dir, no_broadcast):
    tables = star(spark, sf_dir)
    report = R.customer_report(tables.orders, tables.products, tables.customers, AS_OF)
    assert "Window" in plan(report)
    pairs = plan(report.select(*R.GROUP))
    assert "Window" not in pairs and "craftsman_id" not in pairs


def test_lines_of_the_feed_are_written_with_one_order_key(spark, sf_dir):
    text = plan(QUERIES["scan_orders_feed"](spark, sf_dir))
    assert "l_orderkey" in text and "o_orderkey" not in text
