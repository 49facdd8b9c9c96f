from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.tables import AS_OF, FIRST_LOAD, SECOND_LOAD, star
from guildmart.operators import delta, sizing
from guildmart.operators.upsert import load_stamp
from guildmart.plans.report import customer_report
from guildmart.schemas import LOAD_LOG, empty


def test_mark_of_an_empty_log(spark):
    row = delta.read_mark(empty(spark, LOAD_LOG)).first()
    assert row.load_dttm == datetime(1900, 1, 1)


def test_mark_is_the_latest_load(spark):
    log = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 3, 1))], LOAD_LOG)
    assert delta.read_mark(log).first().load_dttm == datetime(2024, 3, 1)


def _delta(spark, sf_dir, mark):
    tables = star(spark, sf_dir)
    return delta.changed_orders(tables.orders, *tables.dims(), load_stamp(mark))


def test_an_empty_delta_moves_the_mark_to_the_run(spark, sf_dir):
    nothing = _delta(spark, sf_dir, SECOND_LOAD)
    assert nothing.count() == 0
    mark = delta.next_mark(nothing, "2024-05-05 00:00:00").first().load_dttm
    assert mark == datetime(2024, 5, 5)


def test_everything_is_changed_before_the_first_load(spark, sf_dir):
    everything = _delta(spark, sf_dir, delta.NEVER)
    assert everything.count() == star(spark, sf_dir).orders.count()
    mark = delta.next_mark(everything, "2024-05-05 00:00:00").first().load_dttm
    assert mark == datetime(2024, 1, 2)


def _pairs(frame):
    return set(map(tuple, frame.select(*delta.PAIR).collect()))


def test_touched_months_are_those_of_the_changed_orders(spark, sf_dir, monkeypatch):
    tables = star(spark, sf_dir)
    mark = load_stamp(FIRST_LOAD)
    loaded = tables.orders.filter(F.col("load_dttm") <= mark)
    report = customer_report(loaded, tables.products, tables.customers, AS_OF)
    expected = _pairs(delta.changed_orders(tables.orders, *tables.dims(), mark))
    for limit in (sizing.BROADCAST_BYTES, 0):
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", limit)
        touched = delta.touched_months(tables.orders, *tables.dims(), report, mark)
        assert _pairs(touched) == expected
        assert touched.count() == len(expected)


def test_customers_fall_into_new_and_existing(spark, sf_dir):
    tables = star(spark, sf_dir)
    changed = delta.changed_orders(tables.orders, *tables.dims(), load_stamp(FIRST_LOAD))
    report = tables.customers.filter("customer_address_building > 50").select("customer_id")
    new = {r[0] for r in delta.new_customers(changed, report).collect()}
    known = {r[0] for r in delta.existing_customers(changed, report).collect()}
    assert new and known and not new & known
    assert new | known == {r[0] for r in changed.select("customer_id").distinct().collect()}


def test_a_repeated_customer_multiplies_no_orders(spark, sf_dir):
    tables = star(spark, sf_dir)
    twice = tables.customers.unionAll(tables.customers)
    assert delta.orders_of(tables.orders, twice).count() == tables.orders.count()
