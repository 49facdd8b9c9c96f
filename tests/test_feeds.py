from __future__ import annotations

from datetime import datetime

from checks.tables import star
from guildmart.operators import quality, sizing
from guildmart.sources.feeds import derived_order_ids, derived_orders_feed
from tests.test_plans import plan

TABLES = {
    "region": ("r_regionkey int, r_name string", [(1, "ASIA")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "CHINA", 1)]),
    # nobody knows the second one's nation
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int", [(1, "one", 1), (2, "two", 9), (3, "three", 1)]),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(1, "ring", "b", "t", 1, 1.0), (1, "ring", "b", "t", 1, 1.0), (2, "bolt", "b", "t", 1, 2.0), (None, "x", "b", "t", 1, 2.0)],
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
        [(n, n % 5, "FOP"[n % 3], datetime(2000, 1, 1 + n)) for n in range(20)],
    ),
    "lineitem": (
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_linestatus string",
        [(n % 21, n // 21, None if n == 7 else 1 + (n % 9 == 0) + (n == 8) * 2, 1 + n % 3, "OF"[n % 2]) for n in range(60)],
    ),
}


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_ids_of_orders_are_those_of_the_feed(spark, tmp_path, monkeypatch):
    """Repeated parts repeat their lines, unknown ones and missing keys have none, however tables are joined."""
    for name, (schema, values) in TABLES.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    feed = derived_orders_feed(spark, str(tmp_path))
    ids = derived_order_ids(spark, str(tmp_path))
    assert rows(ids) == rows(feed.select(*ids.columns)) and 60 > ids.select("id").distinct().count() > 30
    assert ids.count() > ids.distinct().count()
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 10)
    shuffled = derived_order_ids(spark, str(tmp_path))
    assert "SortMergeJoin [l_suppkey" in plan(shuffled)
    assert rows(shuffled) == rows(ids)


def test_orders_are_read_without_their_parts(spark, sf_dir):
    """They met them once, and were written: no part is broadcast at each reading."""
    assert "Join" not in plan(star(spark, sf_dir).orders)


def test_many_parents_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Files of few bytes may hold many keys."""
    for name, keys in (("child", [1, 1, 2, 3]), ("parent", [2])):
        spark.createDataFrame([(k,) for k in keys], "k bigint").write.parquet(f"{tmp_path}/{name}")
    child, parent = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("child", "parent"))
    few = quality.orphans(child, parent, "k")
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 10)
    many = quality.orphans(child, parent, "k")
    assert "BroadcastHashJoin" in plan(few) and "BroadcastHashJoin" not in plan(many)
    assert rows(many) == rows(few) == ["Row(k=1, row_count=2)", "Row(k=3, row_count=1)"]
