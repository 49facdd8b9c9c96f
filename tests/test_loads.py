from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks.tables import AS_OF, feeds
from guildmart.operators import delta, quality
from guildmart.operators.upsert import KEEP_FIRST, LATEST, load_stamp
from guildmart.plans.loads import Load, Policy, increment, read_report, rebuild, refresh_report
from guildmart.plans.report import customer_report
from guildmart.schemas import (
    DIMENSIONS,
    LOG_TABLE,
    ORDERS_TABLE,
    REPORT_TABLE,
    WAREHOUSE,
)
from guildmart.sources.warehouse import Warehouse, shared_folder, written
from tests.samples import ANN, BOB, customers_feed, order_feed_row, orders_feed


def new_warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse")).create()


def rows(warehouse, table, *columns):
    frame = warehouse.read(table, warehouse.snapshot())
    return sorted(map(tuple, frame.select(*(columns or frame.columns)).collect()), key=str)


def recomputed(warehouse):
    tables = warehouse.tables()
    frame = customer_report(tables["orders"], tables["products"], tables["customers"], AS_OF)
    return sorted(map(tuple, frame.collect()), key=str)


def report_rows(warehouse):
    columns = [c for c in REPORT_TABLE.schema.names if c != "id"]
    return rows(warehouse, REPORT_TABLE, *columns)


def test_increments_equal_a_rebuild(spark, sf_dir, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    orders, customers = feeds(spark, sf_dir)
    policy = Policy(on_conflict=KEEP_FIRST)
    # three batches that share customers, products, craftsmen and months
    for n, batch in enumerate((orders.filter("order_status = 'done'"),
                               orders.filter("order_status = 'delivery'"),
                               orders.filter("order_status in ('created', 'in progress')")), 1):
        increment(warehouse, batch, customers, f"2024-01-0{n} 00:00:00", AS_OF, policy)

    report = report_rows(warehouse)
    assert report == recomputed(warehouse)
    tables = warehouse.tables()
    frame = tables["customer_report"]
    assert frame.agg(F.sum("count_order")).first()[0] == tables["orders"].count()
    assert frame.filter("count_order_done + count_order_not_done <> count_order").count() == 0
    for table in (*DIMENSIONS, ORDERS_TABLE, REPORT_TABLE):
        assert quality.duplicate_keys(tables[table.name], [table.id_col]).count() == 0
        assert quality.duplicate_keys(tables[table.name], table.keys).count() == 0
        nulls = quality.forbidden_nulls(tables[table.name], table.schema, table.name)
        assert nulls.filter("null_count > 0").count() == 0
    for name, key in ORDERS_TABLE.parents:
        assert quality.orphans(tables["orders"], tables[name], key).count() == 0

    ids = rows(warehouse, REPORT_TABLE, "id", "customer_id", "report_period")
    rebuild(warehouse, "2024-02-01 00:00:00", AS_OF, policy)
    assert report_rows(warehouse) == report
    assert rows(warehouse, REPORT_TABLE, "id", "customer_id", "report_period") == ids


def batch(spark, *lines):
    return orders_feed(spark, *lines), customers_feed(spark, ANN, BOB)


def test_loading_a_batch_again_moves_only_the_stamps(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    lines = [order_feed_row(n, customer_id=1 + n % 2) for n in range(1, 9)]
    increment(warehouse, *batch(spark, *lines), "2024-01-01 00:00:00", AS_OF)

    def unstamped():
        return [
            rows(warehouse, t, *(c for c in t.schema.names if c != "load_dttm"))
            for t in (*DIMENSIONS, ORDERS_TABLE, REPORT_TABLE)
        ]

    before = unstamped()
    increment(warehouse, *batch(spark, *lines), "2024-01-02 00:00:00", AS_OF)
    assert unstamped() == before
    stamps = {r[0] for r in rows(warehouse, ORDERS_TABLE, "load_dttm")}
    assert stamps == {datetime(2024, 1, 2)}
    assert rows(warehouse, LOG_TABLE) == [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))]


def test_a_changed_order_and_a_new_month_reach_the_report(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    line = order_feed_row(1, order_created_date=date(2023, 1, 5))
    increment(warehouse, *batch(spark, line), "2024-01-01 00:00:00", AS_OF)
    done = order_feed_row(
        1,
        order_created_date=date(2023, 1, 5),
        order_completion_date=date(2023, 1, 9),
        order_status="done",
    )
    later = order_feed_row(2, order_created_date=date(2023, 2, 5))
    increment(warehouse, *batch(spark, done, later), "2024-01-02 00:00:00", AS_OF)
    figures = rows(
        warehouse, REPORT_TABLE, "report_period", "count_order", "count_order_done",
        "median_time_order_completed",
    )
    assert [(r[0], r[1], r[2], r[3] and float(r[3])) for r in figures] == [
        ("2023-01", 1, 1, 4.0),
        ("2023-02", 1, 0, None),
    ]


def test_a_changed_customer_is_renamed_in_all_months(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    lines = [order_feed_row(n, order_created_date=date(2023, n, 5)) for n in (1, 2, 3)]
    increment(warehouse, *batch(spark, *lines), "2024-01-01 00:00:00", AS_OF)
    moved = customers_feed(spark, (1, "Ann Lee", "99 New Road"))
    policy = Policy(only_if_changed=True)
    increment(warehouse, orders_feed(spark, lines[0]), moved, "2024-01-02 00:00:00", AS_OF, policy)
    streets = rows(warehouse, REPORT_TABLE, "report_period", "customer_address_street")
    assert streets == [(f"2023-0{n}", "New Road") for n in (1, 2, 3)]
    assert report_rows(warehouse) == recomputed(warehouse)


def test_unchanged_rows_touch_nothing_if_told_so(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    lines = batch(spark, order_feed_row(1), order_feed_row(2))
    increment(warehouse, *lines, "2024-01-01 00:00:00", AS_OF)
    before = warehouse.snapshot().parts["customer_report"]
    increment(warehouse, *lines, "2024-01-02 00:00:00", AS_OF, Policy(only_if_changed=True))
    assert warehouse.snapshot().parts["customer_report"] == before
    assert {r[0] for r in rows(warehouse, ORDERS_TABLE, "load_dttm")} == {datetime(2024, 1, 1)}


def test_an_empty_batch_only_moves_the_mark(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    increment(warehouse, *batch(spark, order_feed_row(1)), "2024-01-01 00:00:00", AS_OF)
    report = rows(warehouse, REPORT_TABLE)
    nothing = batch(spark, order_feed_row(1))[0].limit(0), customers_feed(spark, ANN)
    increment(warehouse, *nothing, "2024-01-02 00:00:00", AS_OF)
    assert rows(warehouse, REPORT_TABLE) == report
    assert rows(warehouse, LOG_TABLE)[-1] == (2, datetime(2024, 1, 2))


def test_only_touched_months_are_rewritten(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    lines = [order_feed_row(n, order_created_date=date(2023, n, 5)) for n in (1, 2, 3)]
    increment(warehouse, *batch(spark, *lines), "2024-01-01 00:00:00", AS_OF)
    late = order_feed_row(9, order_created_date=date(2023, 3, 9))
    policy = Policy(only_if_changed=True)
    increment(warehouse, *batch(spark, late), "2024-01-02 00:00:00", AS_OF, policy)
    expected = {"2023-01/0-0": 1, "2023-02/0-0": 1, "2023-03/0-0": 2}
    assert warehouse.snapshot().parts["orders"] == expected
    assert warehouse.snapshot().parts["customer_report"] == expected


def test_an_uncommitted_load_is_invisible_and_can_be_repeated(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    increment(warehouse, *batch(spark, order_feed_row(1)), "2024-01-01 00:00:00", AS_OF)
    before = {t.name: rows(warehouse, t) for t in WAREHOUSE}

    broken = Load(warehouse, "2024-01-02 00:00:00", AS_OF)
    staging = broken.stage(*batch(spark, order_feed_row(2)))
    broken.dimensions(staging)
    broken.orders(staging)
    assert {t.name: rows(warehouse, t) for t in WAREHOUSE} == before

    increment(warehouse, *batch(spark, order_feed_row(3)), "2024-01-03 00:00:00", AS_OF)
    assert len(rows(warehouse, ORDERS_TABLE)) == 2
    assert report_rows(warehouse) == recomputed(warehouse)


def test_a_strict_load_fails_and_a_lenient_one_leaves_bad_rows_out(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    lines = batch(spark, order_feed_row(1), order_feed_row(2, craftsman_name="Carl"))
    with pytest.raises(PySparkException, match="incomplete staging row"):
        increment(warehouse, *lines, "2024-01-01 00:00:00", AS_OF)
    assert warehouse.snapshot().last_load == 0
    increment(warehouse, *lines, "2024-01-01 00:00:00", AS_OF, Policy(strict=False))
    assert len(rows(warehouse, ORDERS_TABLE)) == 1


def test_tables_loaded_without_a_report_are_caught_up_later(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    load = Load(warehouse, "2024-01-01 00:00:00", AS_OF)
    staging = load.stage(*batch(spark, order_feed_row(1), order_feed_row(2, customer_id=2)))
    load.dimensions(staging)
    load.orders(staging)
    load.commit()
    assert rows(warehouse, REPORT_TABLE) == []
    refresh_report(warehouse, "2024-01-05 00:00:00", AS_OF)
    assert report_rows(warehouse) == recomputed(warehouse) != []
    # the mark is the newest stamp seen, not the time of the refresh
    assert rows(warehouse, LOG_TABLE, "load_dttm") == [(datetime(2024, 1, 1),)]


def test_the_second_of_two_loads_on_one_snapshot_is_refused(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    first, second = (Load(warehouse, "2024-01-01 00:00:00", AS_OF) for _ in range(2))
    for n, load in enumerate((first, second), 1):
        staging = load.stage(*batch(spark, order_feed_row(n)))
        load.dimensions(staging)
        load.orders(staging)
    first.commit()
    kept = rows(warehouse, ORDERS_TABLE)
    with pytest.raises(PySparkException, match="(?i)already.exists"):
        second.commit()
    assert rows(warehouse, ORDERS_TABLE) == kept != []
    increment(warehouse, *batch(spark, order_feed_row(2)), "2024-01-02 00:00:00", AS_OF)
    assert len(rows(warehouse, ORDERS_TABLE)) == 2


def test_the_log_keeps_to_one_part(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    for day in (1, 2, 3):
        refresh_report(warehouse, f"2024-01-0{day} 00:00:00", AS_OF)
    assert warehouse.snapshot().parts[LOG_TABLE.name] == {"all": 3}
    assert len(rows(warehouse, LOG_TABLE)) == 3


def test_orders_of_earlier_loads_are_not_read_without_changed_dimensions(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    policy = Policy(only_if_changed=True)
    known = order_feed_row(1)
    increment(warehouse, *batch(spark, known), "2024-01-01 00:00:00", AS_OF, policy)
    load = Load(warehouse, "2024-01-02 00:00:00", AS_OF, policy)
    later = order_feed_row(1, id=2, order_id=2, order_created_date=date(2024, 3, 1))
    staging = load.stage(*batch(spark, later))
    load.dimensions(staging)
    load.orders(staging)
    touched = delta.touched_months(
        load.table(ORDERS_TABLE),
        *(load.table(table) for table in DIMENSIONS),
        load.table(REPORT_TABLE),
        load_stamp(load.mark),
        load.warehouse.read(ORDERS_TABLE, load._state(ORDERS_TABLE), load._rewritten(ORDERS_TABLE, load._reported())[0]),
    )
    read = [path for path in touched.inputFiles() if "/orders/" in path]
    assert read and all("/load=2-" in path for path in read)
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(load_dttm" in plan
    assert [row.report_period for row in touched.collect()] == ["2024-03"]


def test_a_stamp_must_be_later_than_the_last_load(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    increment(warehouse, *batch(spark, order_feed_row(1)), "2024-01-02 00:00:00", AS_OF)
    for early in ("2024-01-02 00:00:00", datetime(2024, 1, 1)):
        with pytest.raises(ValueError, match="not after the last load"):
            increment(warehouse, *batch(spark, order_feed_row(2)), early, AS_OF)
    assert warehouse.snapshot().last_load == 1


def test_intermediates_go_to_the_folder_the_session_names(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    frame = written(spark.range(5))
    assert frame.count() == 5
    assert all(folder in name for name in frame.inputFiles())


def test_creating_a_warehouse_twice_keeps_it(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    increment(warehouse, *batch(spark, order_feed_row(1)), "2024-01-01 00:00:00", AS_OF)
    assert new_warehouse(spark, tmp_path).snapshot().last_load == 1
    for table in WAREHOUSE:
        assert warehouse.read(table, warehouse.snapshot()).columns == table.schema.names


def test_ages_are_those_of_a_rebuild_whenever_rows_were_written(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    people = customers_feed(spark, ANN)
    late = order_feed_row(2, order_created_date=date(2025, 3, 1))
    increment(warehouse, orders_feed(spark, order_feed_row(1)), people, "2024-02-01 00:00:00", "2024-02-01")
    increment(warehouse, orders_feed(spark, late), people, "2026-02-01 00:00:00", "2026-02-01", Policy(only_if_changed=True))
    frame = read_report(warehouse, "2026-02-01")
    assert [int(row.avg_age_customer) for row in frame.collect()] == [46, 46]
    assert frame.schema["avg_age_customer"].dataType.simpleString() == "decimal(3,1)"
    before = sorted(map(tuple, frame.collect()), key=str)
    rebuild(warehouse, "2026-02-02 00:00:00", "2026-02-01")
    assert before == rows(warehouse, REPORT_TABLE)


def test_a_rebuild_drops_rows_that_no_order_supports(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    feed = orders_feed(spark, order_feed_row(1), order_feed_row(2, order_created_date=date(2022, 3, 1)))
    increment(warehouse, feed, customers_feed(spark, ANN), "2024-01-01 00:00:00", AS_OF)
    ids = dict(rows(warehouse, REPORT_TABLE, "report_period", "id"))
    load = Load(warehouse, "2024-01-02 00:00:00", AS_OF)
    kept = warehouse.read(ORDERS_TABLE, load.before).filter("order_created_date > '2022-12-31'")
    load._write(ORDERS_TABLE, kept, {"2022-03/0-0", "2023-01/0-0"})
    load.commit()
    rebuild(warehouse, "2024-01-03 00:00:00", AS_OF)
    assert rows(warehouse, REPORT_TABLE, "report_period", "id") == [("2023-01", ids["2023-01"])]
    assert report_rows(warehouse) == recomputed(warehouse)


def test_the_latest_state_of_an_order_is_kept(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    done = order_feed_row(1, id=9, order_status="done", order_completion_date=date(2023, 1, 9))
    feed = orders_feed(spark, done, order_feed_row(1))
    policy = Policy(on_conflict=LATEST)
    increment(warehouse, feed, customers_feed(spark, ANN), "2024-01-01 00:00:00", AS_OF, policy)
    assert rows(warehouse, ORDERS_TABLE, "order_status") == [("done",)]


def test_a_number_that_does_not_fit_is_left_out_or_fails(spark, tmp_path):
    warehouse = new_warehouse(spark, tmp_path)
    feed = orders_feed(spark, order_feed_row(1), order_feed_row(2, craftsman_address="12345678901 Lane"))
    people = customers_feed(spark, ANN)
    with pytest.raises(PySparkException):
        increment(warehouse, feed, people, "2024-01-01 00:00:00", AS_OF)
    increment(warehouse, feed, people, "2024-01-01 00:00:00", AS_OF, Policy(strict=False))
    assert len(rows(warehouse, ORDERS_TABLE)) == 1
    assert [row.reject_reason for row in warehouse.rejected(1).collect()] == ["craftsman_address_building out of range"]
