"""Orders arriving as a stream: each micro-batch is one incremental load."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from guildmart.plans.loads import Policy, increment
from guildmart.sources.warehouse import Warehouse


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def load_stream(
    warehouse: Warehouse,
    orders_stream: DataFrame,
    customers_feed: Callable[[], DataFrame],
    name: str = "orders_feed",
    policy: Policy = Policy(only_if_changed=True),
    clock: Callable[[], datetime] = utc_now,
) -> DataStreamWriter:
    """Writer that loads every micro-batch; set its trigger and checkpoint location and start it.

    The customers feed is read anew for each batch. The batch number is committed together with the
    batch's data, so a batch delivered again after a failure is not loaded twice. Numbers count per
    query id, which a checkpoint keeps: a new checkpoint starts a new sequence and loads everything it
    delivers, merged on natural keys.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("the query's id is unknown, so its batches cannot be told apart")
        mark = f"stream {name} {query_id}"
        if batch_id + 1 <= warehouse.snapshot().max_ids.get(mark, 0):
            return
        now = clock()
        increment(
            warehouse, batch, customers_feed(), now, now.date(), policy, marks={mark: batch_id + 1}
        )

    return orders_stream.writeStream.queryName(name).foreachBatch(load)
