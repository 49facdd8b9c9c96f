from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from guildmart.operators import rekey
from guildmart.operators.staging import build_staging
from guildmart.operators.upsert import merge_single
from guildmart.plans import sums
from guildmart.schemas import CUSTOMERS_TABLE, DIMENSIONS, PRODUCTS_TABLE, REPORT_SUMS, empty
from tests.samples import ANN, BOB, LATER, customers_feed, order_feed_row, orders_feed
from tests.test_plans import plan


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_craftsmen_are_parsed_once_each(spark, tmp_path):
    lines = [order_feed_row(n, craftsman_address=f"{n % 4} Forge Lane", customer_id=1 + n % 3) for n in range(12)]
    orders_feed(spark, *lines).write.parquet(str(tmp_path / "orders"))
    staged = build_staging(spark.read.parquet(str(tmp_path / "orders")), customers_feed(spark, ANN, BOB))
    assert "_craftsman" in plan(staged)
    found = {(row.craftsman_address, row.craftsman_address_building, row.craftsman_surname) for row in staged.collect()}
    assert found == {(f"{n} Forge Lane", n, "Smith") for n in range(4)} and staged.count() == 8


def test_a_number_that_does_not_fit_fails_where_its_line_is_kept(spark):
    """Of a line whose customer is unknown nothing is kept, so it fails no load."""
    long = "99999999999 Forge Lane"
    people = customers_feed(spark, ANN)
    unknown = orders_feed(spark, order_feed_row(1), order_feed_row(2, customer_id=9, craftsman_address=long))
    assert [row.craftsman_address_building for row in build_staging(unknown, people).collect()] == [7]
    known = orders_feed(spark, order_feed_row(1), order_feed_row(2, craftsman_address=long))
    with pytest.raises(PySparkException):
        build_staging(known, people).collect()
    lenient = build_staging(known, people, strict=False).orderBy("id").collect()
    assert [row.craftsman_address_building for row in lenient] == [7, None]


def dimensions(spark, staging):
    found = []
    for table in DIMENSIONS:
        source = staging.select(*table.source_cols).distinct()
        start = F.lit(0).cast("bigint")
        found.append(merge_single(empty(spark, table.schema), source, table, LATER, start=start, anew=True))
    return found


def test_lines_find_their_dimensions_by_hashes_and_by_digests(spark, monkeypatch):
    lines = [order_feed_row(n, customer_id=1 + n % 2, craftsman_name=f"Carl Smith{n % 4}") for n in range(9)]
    lines.append(order_feed_row(9, product_name=None))
    staging = build_staging(orders_feed(spark, *lines), customers_feed(spark, ANN, BOB))
    products, craftsmen, customers = (d.localCheckpoint() for d in dimensions(spark, staging))
    hashed = rekey.rekey(staging, products.filter("product_name <> 'product 3'"), craftsmen, customers)
    assert "sha2" not in plan(hashed) and hashed.count() == 8
    monkeypatch.setattr(rekey, "told_apart", lambda dim, keys: False)
    digested = rekey.rekey(staging, products.filter("product_name <> 'product 3'"), craftsmen, customers)
    assert "sha2" in plan(digested) and rows(digested) == rows(hashed)


def test_hashes_that_meet_are_noticed(spark):
    one = spark.createDataFrame([("a", "b", 1), ("ab", "", 1), (None, "b", 1), (None, "b", 1)], "product_name string, product_description string, product_price bigint")
    assert rekey.told_apart(one, PRODUCTS_TABLE.keys)
    assert not rekey.told_apart(one.unionByName(one), PRODUCTS_TABLE.keys)
    assert one.filter(rekey.key_hash(PRODUCTS_TABLE.keys).isNull()).count() == 2


def test_a_begun_table_has_the_ids_of_a_merge(spark):
    names = [(f"n{n % 50}" if n % 7 else None, f"s{n}", f"e{n}", n, "Main St", None) for n in range(200)]
    columns = ", ".join(f"{c} {CUSTOMERS_TABLE.schema[c].dataType.simpleString()}" for c in CUSTOMERS_TABLE.source_cols)
    source = spark.createDataFrame(names, columns)
    target, start = empty(spark, CUSTOMERS_TABLE.schema), F.lit(5).cast("bigint")
    for places in (None, (F.pmod(F.hash(*CUSTOMERS_TABLE.keys), F.lit(3)).cast("bigint"), 3)):
        merged = merge_single(target, source, CUSTOMERS_TABLE, LATER, start=start, places=places)
        begun = merge_single(target, source, CUSTOMERS_TABLE, LATER, start=start, places=places, anew=True)
        assert rows(begun) == rows(merged) and begun.schema == merged.schema
        assert plan(begun).count("Window") < plan(merged).count("Window")


@pytest.mark.parametrize("seed", [1, 2])
def test_figures_of_written_sums(spark, tmp_path, seed):
    """The median reads days alone; months without any have none."""
    pick = random.Random(seed)
    found = {}
    for _ in range(400):
        kind = pick.choice((sums.CATEGORY, sums.CRAFTSMAN, sums.DAYS))
        item = pick.choice("abc") if kind == sums.CATEGORY else str(pick.randrange(1, 13))
        n = pick.randrange(1, 4)
        found[pick.randrange(20), f"2023-0{pick.randrange(1, 4)}", kind, item] = (n * 7, n, n, n, 0, 0, 0, n)
    frame = spark.createDataFrame([(*k, *v) for k, v in found.items()], REPORT_SUMS)
    frame.write.parquet(str(tmp_path / "sums"))
    kept = spark.read.parquet(str(tmp_path / "sums"))
    apart = sums.written_figures(kept)
    whole = sums.figures(kept).select(*apart.columns)
    assert rows(apart) == rows(whole)
    wanted = kept.select("customer_id", "report_period").distinct().filter("customer_id < 9")
    assert rows(sums.figures_of(kept, wanted, sums.written_figures)) == rows(whole.filter("customer_id < 9"))
