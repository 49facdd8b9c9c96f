"""Surrogate keys given to new rows without a global sort, a counter or a second pass.

Rows are spread over a fixed number of buckets by a digest of their natural key; the n-th row of
bucket b gets ``start + 1 + b + (n - 1) * BUCKETS``. Two rows never share (b, n), so ids are unique;
they depend on the rows alone, so a recomputed task gives the same ids; and because natural keys are
unique, buckets are even whatever the keys look like. Ids have gaps, as identity columns may.

Where ids must have none, ``dense_ids`` numbers rows in order of their keys: they are written in ranges,
counted per range, and each row gets the rows of the ranges before it plus its place in its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from guildmart.sources.shared import written

DIGEST_DIGITS = 5
BUCKETS = 16**DIGEST_DIGITS
SEPARATOR = "\u001f"


def bucket(keys: list[str] | tuple[str, ...]) -> Column:
    text = F.concat_ws(SEPARATOR, *(F.col(k).cast("string") for k in keys))
    digits = F.substring(F.md5(text), 1, DIGEST_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")


def highest_id(table: DataFrame, id_col: str) -> Column:
    """Largest id in use, 0 for an empty table, as a scalar subquery."""
    return table.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).scalar()


def assign_ids(
    rows: DataFrame, keys: list[str] | tuple[str, ...], id_col: str, start: Column
) -> DataFrame:
    """Add ``id_col`` to rows that have none; ``start`` is the highest id already in use."""
    rest = [c for c in rows.columns if c not in keys]
    in_bucket = W.partitionBy("_bucket").orderBy(*keys, *rest)
    return (
        rows.withColumn("_bucket", bucket(keys))
        .withColumn("_n", F.row_number().over(in_bucket))
        .withColumn(
            id_col, start + 1 + F.col("_bucket") + (F.col("_n").cast("bigint") - 1) * BUCKETS
        )
        .drop("_bucket", "_n")
    )


def dense_ids(rows: DataFrame, keys: list[str] | tuple[str, ...], id_col: str, start: int = 0) -> DataFrame:
    """Add ``id_col``: the rows' places in the order of ``keys``, from ``start`` + 1 on, without gaps.

    The order is that of a global sort, but no task sorts more than its range. NULLs come first; equal
    keys are in order of the other columns. Collected is one count per range.
    """
    rest = [c for c in rows.columns if c not in keys]
    ranged = rows.repartitionByRange(*keys, *rest).sortWithinPartitions(*keys, *rest)
    # Written, as the ranges are drawn from a sample and places in them must not move.
    ranged = written(ranged.withColumn("_place", F.monotonically_increasing_id()))
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted(map(tuple, ranged.groupBy(part.alias("part")).count().collect()))
    before, firsts = start, []
    for number, n in counts:
        firsts.append((number, before))
        before += n
    offsets = rows.sparkSession.createDataFrame(firsts, "_part bigint, _before bigint")
    joined = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.select(*rows.columns, (F.col("_before") + place + 1).alias(id_col))
