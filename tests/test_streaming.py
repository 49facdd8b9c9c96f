from __future__ import annotations

from datetime import date, datetime, timedelta

from guildmart.plans.report import customer_report
from guildmart.schemas import ORDERS_FEED, ORDERS_TABLE
from guildmart.sources.warehouse import Warehouse
from guildmart.streaming.feed import load_stream
from tests.samples import ANN, BOB, customers_feed, order_feed_row, orders_feed


def test_a_stream_of_orders_is_loaded_batch_by_batch(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w")).create()
    incoming = str(tmp_path / "incoming")
    times = iter(datetime(2024, 1, 1) + timedelta(days=n) for n in range(9))

    def run(checkpoint: str) -> None:
        stream = spark.readStream.schema(ORDERS_FEED).parquet(incoming)
        writer = load_stream(
            warehouse, stream, lambda: customers_feed(spark, ANN, BOB), clock=lambda: next(times)
        )
        query = (
            writer.option("checkpointLocation", str(tmp_path / checkpoint))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        assert query.exception() is None

    orders_feed(spark, order_feed_row(1), order_feed_row(2)).write.mode("append").parquet(incoming)
    run("checkpoint")
    late = order_feed_row(3, customer_id=2, order_created_date=date(2023, 2, 2))
    orders_feed(spark, late).write.mode("append").parquet(incoming)
    run("checkpoint")

    snapshot = warehouse.snapshot()
    assert snapshot.last_load == 2
    tables = warehouse.tables()
    assert tables["orders"].count() == 3
    report = customer_report(
        tables["orders"], tables["products"], tables["customers"], date(2024, 1, 2)
    )
    assert sorted(tables["customer_report"].drop("id").collect()) == sorted(report.collect())

    # a new checkpoint numbers from 0 again: known and unseen orders are all there, once each
    orders_feed(spark, order_feed_row(4)).write.mode("append").parquet(incoming)
    run("other")
    snapshot = warehouse.snapshot()
    assert snapshot.last_load == 3
    loaded = warehouse.read(ORDERS_TABLE, snapshot)
    assert loaded.count() == loaded.select("order_id").distinct().count() == 4
