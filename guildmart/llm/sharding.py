"""Shards of near equal bytes by sampled splitters, in DataFrame functions alone.

A size-weighted sample of the records' keys gives quantile boundaries of many narrow ranges, and
records are range-partitioned by them. A range with more than twice its share of bytes, such as one
that holds a large group of equal keys, is subdivided: by key, and a group of over 1/100 of a shard
by doc_id. Exact byte and row counts of the ranges (a bounded table) then place every record: a
window within its range gives its offset among all bytes, and the offset gives the shard. A group of
equal keys goes where it starts as a whole, unless it has over 1/100 of a shard's bytes.

Defined results: a missing or empty text counts 8 bytes; all missing texts are one group, all empty
ones another. Repeated rows are records of their own. A missing doc_id sorts first within its group.
Columns of the input that are named like a result column are replaced, others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from guildmart.sources.warehouse import written

N_SHARDS = 24
RANGES_PER_SHARD = 64
SAMPLE_PER_RANGE = 8
GROUPS_PER_SHARD = 100
ROW_BYTES = 8


def record_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + ROW_BYTES


def splitters(records: DataFrame, total: int, ranges: int, per_range: int) -> list[int]:
    """Up to ``ranges - 1`` boundaries: quantiles of a sample in which a byte counts like any other."""
    if not total:
        return []
    wanted = ranges * per_range
    chance = F.pmod(F.xxhash64("_id", "_key", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    taken = F.floor(F.col("_size") * F.lit(wanted / total) + chance).cast("int")
    sample = records.select("_key", F.explode(F.array_repeat(F.lit(1), taken)).alias("one"))
    at = [i / ranges for i in range(1, ranges)]
    return sorted(set(sample.agg(F.percentile_approx("_key", at, 100 * ranges).alias("at")).first()["at"] or []))


def range_of(key: Column, bounds: list[int]) -> Column:
    """How many boundaries are at most the key, by binary search."""
    table = F.lit(bounds).cast("array<bigint>") if bounds else F.array().cast("array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, len(bounds).bit_length())))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda low, step: F.when(F.get(table, low + step - 1) <= key, low + step).otherwise(low),
    )


def place_groups(groups: list[tuple[int, int]], n_shards: int, total: int) -> tuple[dict[int, int], list[int]]:
    """The shard of each (key, bytes), the largest first into the emptiest; and where on the line of all
    other bytes each shard but the last ends, so that all shards are filled to one level."""
    loads, homes = [0] * n_shards, {}
    for size, key in sorted(((size, key) for key, size in groups), key=lambda x: (-x[0], x[1])):
        home = loads.index(min(loads))
        homes[key] = home
        loads[home] += size
    rest, order = total - sum(loads), sorted(loads)
    level = 0.0
    for n in range(1, n_shards + 1):
        level = (rest + sum(order[:n])) / n
        if n == n_shards or level <= order[n]:
            break
    ends, end = [], 0.0
    for load in loads[:-1]:
        end += max(0.0, level - load)
        ends.append(round(end))
    return homes, ends


def shard(
    docs: DataFrame,
    n_shards: int = N_SHARDS,
    key: Column | None = None,
    size: Column | None = None,
) -> DataFrame:
    """The input's rows with ``shard`` (from 0) and ``slot`` (gapless from 0 within the shard).

    Groups are rows of equal ``key``, by default a hash of the text; ``size`` is by default the bytes
    of the text plus 8.
    """
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    records = written(
        docs.select(
            *own,
            (F.xxhash64("text") if key is None else key).alias("_key"),
            (record_bytes() if size is None else size).alias("_size"),
            F.xxhash64("doc_id").alias("_id"),
        )
    )
    total = records.agg(F.coalesce(F.sum("_size"), F.lit(0)).alias("bytes")).first().bytes
    ranges = n_shards * RANGES_PER_SHARD
    bounds = splitters(records, total, ranges, SAMPLE_PER_RANGE)
    ranged = records.withColumn("_range", range_of(F.col("_key"), bounds))
    # At most GROUPS_PER_SHARD * n_shards groups can be that large.
    large = (
        records.groupBy("_key").agg(F.sum("_size").alias("_bytes"))
        .where(F.col("_bytes") * (n_shards * GROUPS_PER_SHARD) > total)
    )
    found = [(r["_key"], r["_bytes"]) for r in large.collect()]
    fits = [x for x in found if x[1] * n_shards <= total]
    homes, ends = place_groups(fits, n_shards, total)
    known = [(key, homes.get(key)) for key, _ in found]
    large = docs.sparkSession.createDataFrame(known, "_key bigint, _home int").withColumn("_large", F.lit(True))
    # A group that fits a shard is a range of its own shard, after all others; one that does not is split.
    ranged = (
        ranged.join(F.broadcast(large), "_key", "left")
        .withColumn("_large", F.coalesce("_large", F.lit(False)))
        .withColumn("_range", F.when(F.col("_home").isNull(), F.col("_range")).otherwise(F.col("_home") + F.lit(len(bounds) + 1)))
    )
    # At most one row per range.
    parts = ranged.groupBy("_range").agg(
        F.ceil(F.sum("_size") / F.lit(max(1.0, 2 * total / ranges))).cast("int").alias("_parts")
    )
    cut = (
        ranged.join(F.broadcast(parts), "_range")
        .withColumn(
            "_part",
            F.when(F.col("_parts") <= 1, 0).otherwise(
                F.pmod(F.when(F.col("_large"), F.xxhash64("_id", F.lit(1))).otherwise(F.xxhash64("_key", F.lit(1))), "_parts")
            ).cast("int"),
        )
        .drop("_parts")
    )
    # At most 1.5 times as many rows as there are ranges.
    before = Window.orderBy("_range", "_part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cut.groupBy("_range", "_part").agg(F.sum("_size").alias("_b"), F.count(F.lit(1)).alias("_r")).select(
        "_range",
        "_part",
        F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_r").over(before), F.lit(0)).alias("_rows_before"),
    )
    order = Window.partitionBy("_range", "_part").orderBy("_key", "_id", "_size")
    group = Window.partitionBy("_range", "_part", "_key")
    start = F.col("_bytes_before") + F.coalesce(
        F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    placed = (
        cut.join(F.broadcast(cells), ["_range", "_part"])
        .withColumn("_start", start)
        .withColumn("_row", F.col("_rows_before") + F.row_number().over(order) - 1)
        .withColumn("_start", F.when(F.col("_large"), F.col("_start")).otherwise(F.min("_start").over(group)))
        .withColumn("shard", F.coalesce("_home", F.least(F.lit(n_shards - 1), range_of(F.col("_start"), ends))).cast("int"))
        .select(*own, "shard", "_row", F.col("_home").isNotNull().alias("_whole"))
    )
    placed = written(placed)
    # In a shard the rows of whole groups come after the others.
    runs = placed.groupBy("shard").agg(
        F.min(F.when(~F.col("_whole"), F.col("_row"))).alias("_first"),
        F.count(F.when(~F.col("_whole"), 1)).alias("_n"),
        F.min(F.when(F.col("_whole"), F.col("_row"))).alias("_first_whole"),
    )
    slot = F.when(F.col("_whole"), F.col("_row") - F.col("_first_whole") + F.col("_n")).otherwise(F.col("_row") - F.col("_first"))
    slotted = placed.join(F.broadcast(runs), "shard").withColumn("slot", slot)
    return slotted.select(*own, "shard", F.col("slot").cast(T.LongType()).alias("slot"))
