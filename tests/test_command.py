from __future__ import annotations

import pytest

from guildmart.__main__ import main
from guildmart.schemas import LOG_TABLE, ORDERS_TABLE, REPORT_TABLE
from guildmart.sources.warehouse import Warehouse
from tests.samples import ANN, BOB, customers_feed, order_feed_row, orders_feed


def test_feeds_are_loaded_from_files(spark, tmp_path):
    feeds, root = tmp_path / "feeds", str(tmp_path / "warehouse")
    lines = orders_feed(spark, order_feed_row(1), order_feed_row(2, customer_id=2))
    lines.write.json(f"{feeds}/orders")
    customers_feed(spark, ANN, BOB).write.json(f"{feeds}/customers")
    main(
        ["increment", "--warehouse", root, "--format", "json", "--load-ts", "2024-01-01 00:00:00"]
        + ["--orders", f"{feeds}/orders", "--customers", f"{feeds}/customers"]
    )
    main(["refresh", "--warehouse", root])
    warehouse = Warehouse(spark, root)
    tables = warehouse.tables()
    assert tables[ORDERS_TABLE.name].count() == 2
    assert tables[REPORT_TABLE.name].count() == 2
    assert tables[LOG_TABLE.name].count() == 2


def test_an_increment_needs_both_feeds(tmp_path):
    with pytest.raises(SystemExit):
        main(["increment", "--warehouse", str(tmp_path), "--orders", "somewhere"])
