"""Joins of raw rows to a table with unique keys, in which no key brings its rows into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guildmart.operators.sizing import is_small
from guildmart.sources.shared import written

# A key is hot if its rows are more than this share of an average task's, and is cut into pieces of it.
PIECE = 8
# Keys are counted together first, in this many places for each share, so that few counts are shuffled.
PLACES = 8


def _place(keys: Sequence[str], tasks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(tasks * PIECE * PLACES))


def hot_places(rows: DataFrame, keys: Sequence[str], tasks: int) -> tuple[list[int], int]:
    """The places of the keys' digest with more rows than a hot key has at least, and that number.

    Collected are a fixed number of counts for each task. A hot key's place is always among them.
    """
    counts = rows.groupBy(_place(keys, tasks).alias("place")).agg(F.count(F.lit(1)).alias("n")).collect()
    most = max(1, sum(row.n for row in counts) // (tasks * PIECE))
    return sorted(row.place for row in counts if row.n > most), most


def hot_keys(rows: DataFrame, keys: Sequence[str], tasks: int, found: tuple[list[int], int] | None = None) -> DataFrame:
    """(keys, _pieces) of the hot keys, fewer than ``PIECE`` per task, counted with a combine per task.

    Only rows in ``hot_places``, which may be given as ``found``, are counted by key.
    """
    places, most = found or hot_places(rows, keys, tasks)
    counted = rows.filter(_place(keys, tasks).isin(places)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    pieces = F.ceil(F.col("_n") / F.lit(most)).cast("int").alias("_pieces")
    return counted.filter(F.col("_n") > most).select(*keys, pieces)


def apart(rows: DataFrame, columns: Sequence[str], number: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows with a number in place of some columns, whose values repeat, and what the numbers stand for.

    For shuffles of rows that carry much text; joined back by the number afterwards. Values as many as
    cannot be broadcast stay in the rows.
    """
    values = rows.select(*columns).distinct().withColumn(number, F.monotonically_increasing_id())
    values = written(values)  # numbers are given once
    if not is_small(values):
        return rows, None
    named = values.select(number, *(F.col(c).alias(f"_{c}") for c in columns))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns))
    kept = [c for c in rows.columns if c not in columns]
    return rows.join(F.broadcast(named), same).select(*kept, number), values


def join_unique(rows: DataFrame, unique: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """Inner join of ``rows`` to ``unique``, which has at most one row per key.

    A small ``unique`` is broadcast. Else both sides are shuffled, and the hot keys, which are counted
    first, are dealt out: each of their rows goes to one of the key's pieces, and the one row of
    ``unique`` to all of them. ``rows`` are read twice then (three times if there are hot keys), so write
    them down if they are costly.
    """
    if is_small(unique, limit):
        return rows.join(F.broadcast(unique), list(keys))
    return join_dealt(rows, unique, keys)


def join_dealt(rows: DataFrame, unique: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The shuffled way of ``join_unique``, which the optimizer is kept from leaving: it goes by the size of
    files."""
    keys = list(keys)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = hot_places(rows, keys, tasks)
    if not found[0]:
        return rows.join(unique.hint("merge"), keys)
    hot = F.broadcast(hot_keys(rows, keys, tasks, found))
    pieces = F.coalesce("_pieces", F.lit(1))
    # equal rows are dealt out too: by their place, not by their values
    piece = F.pmod(F.monotonically_increasing_id(), pieces.cast("bigint")).cast("int")
    dealt = rows.join(hot, keys, "left").withColumn("_piece", piece).drop("_pieces")
    copies = unique.join(hot, keys, "left").withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return dealt.join(copies.drop("_pieces").hint("merge"), [*keys, "_piece"]).drop("_piece")
