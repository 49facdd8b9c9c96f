from __future__ import annotations

from pyspark.sql import functions as F

from guildmart.operators import sizing


def test_size_counts_text_and_values(spark):
    rows = spark.createDataFrame([(1, "ab"), (2, None), (3, "Ж")], "n bigint, t string")
    assert sizing.measured_bytes(rows) == 3 * 2 * sizing.VALUE_BYTES + 4
    assert sizing.measured_bytes(rows.limit(0)) == 0


def test_long_text_is_not_small_however_few_rows(spark):
    rows = spark.range(10).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert sizing.is_small(rows, 20_000)
    assert not sizing.is_small(rows, 10_000)
