from __future__ import annotations

import random
import statistics
from collections import Counter, defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from guildmart.operators import sizing
from guildmart.plans import report as R
from guildmart.plans import sums
from guildmart.schemas import REPORT
from tests.samples import customers, orders, products

JAN = date(2023, 1, 10)
AS_OF = "2024-01-01"


def report(spark, rows, prices, *people):
    return R.customer_report(
        orders(spark, *rows), products(spark, prices), customers(spark, *people), AS_OF
    )


def only(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]


def test_contract(spark):
    frame = report(spark, [(1, 1, 1, JAN, None, "done")], {1: ("toys", 5)}, 1)
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in REPORT]


def test_median_ignores_open_orders(spark):
    rows = [(1, 1, 1, JAN, JAN + timedelta(d), "done") for d in (1, 4)]
    rows.append((1, 1, 1, JAN, None, "created"))
    row = only(report(spark, rows, {1: ("toys", 5)}, 1))
    assert row.median_time_order_completed == Decimal("2.5")


def test_median_of_open_orders_is_null(spark):
    row = only(report(spark, [(1, 1, 1, JAN, None, "created")], {1: ("toys", 5)}, 1))
    assert row.median_time_order_completed is None


def test_ties_go_to_the_smallest(spark):
    rows = [(1, 9, 1, JAN, None, "done"), (2, 4, 1, JAN, None, "done")]
    row = only(report(spark, rows, {1: ("toys", 5), 2: ("cups", 7)}, 1))
    assert (row.top_product_category, row.top_craftsman) == ("cups", 4)


def test_tops_are_taken_within_the_month(spark):
    feb = date(2023, 2, 1)
    rows = [(1, 1, 1, JAN, None, "done")] * 3 + [(2, 2, 1, feb, None, "done")]
    tops = {
        r.report_period: (r.top_product_category, r.top_craftsman)
        for r in report(spark, rows, {1: ("toys", 5), 2: ("cups", 7)}, 1).collect()
    }
    assert tops == {"2023-01": ("toys", 1), "2023-02": ("cups", 2)}


def test_unknown_status_counts_as_not_done_only(spark):
    row = only(report(spark, [(1, 1, 1, JAN, None, "returned")], {1: ("toys", 125)}, 1))
    assert (row.count_order, row.count_order_not_done, row.count_order_done) == (1, 1, 0)
    assert row.count_order_created + row.count_order_in_progress + row.count_order_delivery == 0
    assert row.platform_money == 13


def test_an_age_that_does_not_fit_fails(spark):
    people = customers(spark, 1).withColumn("customer_birthday", F.lit(date(1900, 1, 1)))
    frame = R.customer_report(
        orders(spark, (1, 1, 1, JAN, None, "done")), products(spark, {1: ("toys", 5)}), people, AS_OF
    )
    with pytest.raises(PySparkException):
        frame.collect()


def test_orders_without_customer_or_month_have_no_row(spark):
    found = orders(spark, (1, 1, 1, JAN, None, "done"), (1, 1, 2, JAN, None, "done"), (1, 1, 3, JAN, None, "done"))
    gone = {
        "customer_id": F.when(F.col("customer_id") != 2, F.col("customer_id")),
        "order_created_date": F.when(F.col("order_id") != 3, F.col("order_created_date")),
        "craftsman_id": F.lit(None).cast("bigint"),
    }
    frame = R.customer_report(found.withColumns(gone), products(spark, {1: ("toys", 5)}), customers(spark, 1, 2, 3), AS_OF)
    row = only(frame)
    assert (row.customer_id, row.report_period, row.top_craftsman) == (1, "2023-01", None)
    assert [tuple(r) for r in frame.select(*R.GROUP).collect()] == [(1, "2023-01")]


def random_case(seed):
    rng = random.Random(seed)
    prices = {n: (rng.choice(["toys", "cups", "hats"]), rng.randint(1, 999)) for n in range(1, 21)}
    statuses = ["created", "in progress", "delivery", "done", "returned"]
    rows = []
    for _ in range(400):
        # one customer holds a third of everything
        customer = 1 if rng.random() < 0.34 else rng.randint(1, 12)
        created = date(2023, 1, 1) + timedelta(rng.randint(0, 120))
        completed = created + timedelta(rng.randint(0, 40)) if rng.random() < 0.6 else None
        rows.append((rng.randint(1, 20), rng.randint(1, 6), customer, created, completed, rng.choice(statuses)))
    return rows, prices


def brute_force(rows, prices):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2], f"{row[3]:%Y-%m}"].append(row)

    def top(values):
        return min(Counter(values).items(), key=lambda item: (-item[1], item[0]))[0]

    result = set()
    for (customer, month), lines in groups.items():
        total = sum(prices[line[0]][1] for line in lines)
        days = [(line[4] - line[3]).days for line in lines if line[4]]
        states = Counter(line[5] for line in lines)
        result.add(
            (
                customer,
                month,
                Decimal(total),
                int((Decimal(total) / 10).quantize(Decimal(1), ROUND_HALF_UP)),
                len(lines),
                (Decimal(total) / len(lines)).quantize(Decimal("0.01"), ROUND_HALF_UP),
                Decimal(str(statistics.median(days))) if days else None,
                top(prices[line[0]][0] for line in lines),
                top(line[1] for line in lines),
                states["created"],
                states["in progress"],
                states["delivery"],
                states["done"],
                len(lines) - states["done"],
            )
        )
    return result


FIGURES = [
    "customer_id",
    "report_period",
    "customer_money",
    "platform_money",
    "count_order",
    "avg_price_order",
    "median_time_order_completed",
    "top_product_category",
    "top_craftsman",
    "count_order_created",
    "count_order_in_progress",
    "count_order_delivery",
    "count_order_done",
    "count_order_not_done",
]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_report_equals_brute_force(spark, seed):
    rows, prices = random_case(seed)
    frame = report(spark, rows, prices, *range(1, 13))
    assert {tuple(r) for r in frame.select(*FIGURES).collect()} == brute_force(rows, prices)


@pytest.mark.parametrize("limit", [0, sizing.BROADCAST_BYTES])
def test_report_of_touched_months_is_a_part_of_the_whole(spark, monkeypatch, limit):
    """Both ways of matching the touched months: after the aggregation and by broadcast."""
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", limit)
    rows, prices = random_case(4)
    tables = orders(spark, *rows), products(spark, prices), customers(spark, *range(1, 13))
    whole = R.customer_report(*tables, AS_OF).collect()
    pairs = sorted({(r.customer_id, r.report_period) for r in whole})[::3]
    touched = spark.createDataFrame(pairs, "customer_id bigint, report_period string")
    part = R.customer_report_for(touched, *tables, AS_OF).collect()
    wanted = set(pairs)
    assert set(part) == {r for r in whole if (r.customer_id, r.report_period) in wanted}


def test_as_written_rows_repeat_per_tie_and_craftsman(spark):
    feb = date(2023, 2, 1)
    rows = [
        (1, 1, 1, JAN, None, "done"),
        (2, 2, 1, feb, None, "done"),
        (2, 3, 1, feb, None, "done"),
        (1, 1, 1, feb, None, "done"),
        (2, 2, 2, JAN, None, "done"),
    ]
    lines = R.order_lines(orders(spark, *rows), products(spark, {1: ("toys", 5), 2: ("cups", 7)}))
    counted = {
        (r.customer_id, r.report_period): (r.tied_categories, r.craftsmen, r.written_rows)
        for r in R.report_as_written(lines, customers(spark, 1, 2), AS_OF).collect()
    }
    # customer 1 has two toys and two cups from three craftsmen over both months
    assert counted == {(1, "2023-01"): (2, 3, 6), (1, "2023-02"): (2, 3, 6), (2, "2023-01"): (1, 1, 1)}


def test_sums_after_a_change_give_their_figures_without_another_shuffle(spark, tmp_path):
    january = orders(spark, *((n % 3 + 1, 7, 1, JAN, None, "done") for n in range(6)))
    goods = products(spark, {n: (f"type{n}", 10 * n) for n in (1, 2, 3)})
    none = january.limit(0)
    for name, frame in (("kept", january), ("change", january.filter("product_id < 3"))):
        sums.changes(frame, none, goods, goods).write.parquet(str(tmp_path / name))
    kept, change = (spark.read.parquet(str(tmp_path / name)) for name in ("kept", "change"))
    found = sums.figures(sums.applied(kept, change))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert found.first().count_order == 10
    by_place = sums.applied(kept, change, F.lit(0)).collect()
    assert sorted(map(str, by_place)) == sorted(map(str, sums.applied(kept, change).collect()))
