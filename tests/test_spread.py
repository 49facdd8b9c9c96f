from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from guildmart.operators.keys import dense_ids
from guildmart.operators.spread import hot_keys, hot_places, join_unique
from tests.test_plans import plan


@pytest.fixture
def not_adaptive(spark):
    """Nothing is planned again at run time, and only what is hinted is broadcast."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def lines(spark, n=60_000):
    """A third of the lines have one product, a tenth none."""
    product = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 997)
    return spark.range(0, n, 1, 8).select(product.cast("bigint").alias("product_id"), F.lit("same").alias("note"))


def test_a_hot_product_is_dealt_out(spark, not_adaptive):
    products = spark.range(997).select(F.col("id").alias("product_id"), (F.col("id") * 2).alias("price"))
    joined = join_unique(lines(spark), products, ["product_id"], limit=0)
    assert "BroadcastHashJoin" in plan(joined) and "SortMergeJoin" in plan(joined)
    sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]
    wanted = lines(spark).filter("product_id is not null")
    assert joined.count() == wanted.count()
    assert joined.agg(F.sum("price")).first()[0] == 2 * wanted.agg(F.sum("product_id")).first()[0]
    assert joined.columns == ["product_id", "note", "price"]


def test_a_small_table_is_broadcast(spark):
    products = spark.range(997).withColumnRenamed("id", "product_id")
    joined = join_unique(lines(spark, 100), products, ["product_id"])
    assert "SortMergeJoin" not in plan(joined)


def test_unknown_and_missing_keys_match_nothing(spark):
    unique = spark.createDataFrame([(1, "a", 9), (None, "b", 8)], "k bigint, l string, v int")
    raw = spark.createDataFrame([(1, "a"), (1, "a"), (1, "x"), (None, "b")], "k bigint, l string")
    for limit in (None, 0):
        assert sorted(map(tuple, join_unique(raw, unique, ["k", "l"], limit).collect())) == [(1, "a", 9)] * 2
        assert join_unique(raw.limit(0), unique, ["k", "l"], limit).collect() == []


def test_hot_keys_are_bounded(spark):
    found = hot_keys(lines(spark), ["product_id"], 8).collect()
    assert {r.product_id for r in found} >= {7} and len(found) <= 64
    assert max(r._pieces for r in found if r.product_id == 7) >= 20


def test_dense_ids_have_no_gaps_and_follow_the_keys(spark, sf_dir):
    rows = spark.range(0, 5000, 1, 7).select(F.xxhash64("id").alias("a"), F.lit("x").alias("b"))
    found = dense_ids(rows, ["a"], "n", start=10).orderBy("n").collect()
    assert [r.n for r in found] == list(range(11, 5011))
    assert [r.a for r in found] == sorted(r.a for r in found)
    same = spark.createDataFrame([(None, 1), (None, 1), ("k", 2)], "a string, b int")
    assert sorted(r.n for r in dense_ids(same, ["a"], "n").collect()) == [1, 2, 3]
    assert dense_ids(same.limit(0), ["a"], "n").collect() == []


def test_rows_without_a_hot_key_are_not_dealt_out(spark, not_adaptive):
    """No count by key is shuffled or broadcast for them."""
    rows = spark.range(0, 60_000, 1, 8).select((F.col("id") % 60_000).alias("k"))
    joined = join_unique(rows, spark.range(60_000).withColumnRenamed("id", "k"), ["k"], limit=0)
    assert "SortMergeJoin" in plan(joined) and "Broadcast" not in plan(joined)
    assert joined.count() == 60_000


def test_keys_are_counted_together_before_they_are_counted_alone(spark):
    places, most = hot_places(lines(spark), ["product_id"], 8)
    assert most == 60_000 // 64 and 0 < len(places) < 64
    even = spark.range(0, 60_000, 1, 8).withColumnRenamed("id", "product_id")
    assert hot_places(even, ["product_id"], 8)[0] == []
    assert hot_keys(even, ["product_id"], 8).collect() == []
