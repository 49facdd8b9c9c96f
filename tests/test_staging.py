from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from guildmart.operators import sizing
from guildmart.operators.spread import apart
from guildmart.operators.staging import (
    CRAFTSMAN_TEXT,
    REASON,
    accepted,
    build_staging,
    rejected,
    require_complete,
)
from guildmart.schemas import STAGING
from tests.samples import ANN, BOB, customers_feed, order_feed_row, orders_feed


def staged(spark, people, *rows):
    return build_staging(orders_feed(spark, *rows), customers_feed(spark, *people))


def test_names_and_addresses_are_split(spark):
    row = staged(spark, [ANN], order_feed_row(1)).first()
    assert (row.customer_name_all, row.customer_name, row.customer_surname) == (
        "Ann Lee",
        "Ann",
        "Lee",
    )
    assert (row.customer_address_building, row.customer_address_street) == (12, "Main St")
    assert (row.craftsman_name, row.craftsman_surname) == ("Carl", "Smith")
    assert (row.craftsman_address_building, row.craftsman_address_street) == (7, "Forge Lane")
    assert row.craftsman_address == "7 Forge Lane"


def test_columns_follow_the_contract(spark):
    assert staged(spark, [ANN], order_feed_row(1)).columns == STAGING.names


def test_orders_of_unknown_customers_are_dropped(spark):
    lines = staged(spark, [ANN], order_feed_row(1), order_feed_row(2, customer_id=9))
    assert [r.order_id for r in lines.collect()] == [1]


@pytest.mark.parametrize(
    ("person", "reason"),
    [
        ((1, "Ann", "12 Main St"), "customer_surname"),
        ((1, "Ann Lee", "Main St"), "customer_address_building"),
        ((1, "Ann Lee", "12 Улица"), "customer_address_street"),
        ((1, "Ann", "12 A"), "customer_surname,customer_address_street"),
    ],
)
def test_incomplete_rows_are_kept_apart_with_their_reason(spark, person, reason):
    lines = staged(spark, [person, BOB], order_feed_row(1), order_feed_row(2, customer_id=2))
    assert [(r.order_id, r[REASON]) for r in rejected(lines).collect()] == [(1, reason)]
    assert [r.order_id for r in accepted(lines).collect()] == [2]
    with pytest.raises(PySparkException, match="incomplete staging row: customer"):
        require_complete(lines).collect()


def test_an_open_order_is_complete(spark):
    lines = staged(spark, [ANN], order_feed_row(1, order_completion_date=None))
    assert rejected(lines).count() == 0
    assert require_complete(lines).count() == 1


def test_lines_are_shuffled_without_their_craftsmen_texts(spark, monkeypatch, tmp_path):
    """Shuffled to many customers, a line carries a number for them; missing texts match each other."""
    people = [(n, f"Ann Lee{n}", f"{n} Main St") for n in range(1, 29)]
    feeds = (
        orders_feed(
            spark,
            *(order_feed_row(n, customer_id=n % 30) for n in range(60)),
            *(order_feed_row(n, craftsman_name=None, craftsman_birthday=None) for n in range(60, 63)),
            order_feed_row(63, craftsman_name="Eve Ray", craftsman_id=1),
        ),
        customers_feed(spark, *people),
    )
    feeds[0].write.parquet(str(tmp_path / "orders"))
    feeds = spark.read.parquet(str(tmp_path / "orders")), feeds[1]
    direct = build_staging(*feeds).collect()
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 1000)
    shuffled = build_staging(*feeds)
    assert sorted(map(str, shuffled.collect())) == sorted(map(str, direct)) and len(direct) == 60
    plan = shuffled._jdf.queryExecution().executedPlan().toString()
    assert "_craftsman" in plan, plan
    lines, texts = apart(feeds[0], CRAFTSMAN_TEXT, "_craftsman")
    assert not {*CRAFTSMAN_TEXT} & {*lines.columns} and texts.count() == 3
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 10)
    assert apart(feeds[0], CRAFTSMAN_TEXT, "_craftsman") == (feeds[0], None)
