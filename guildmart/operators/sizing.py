"""Broadcast only what was measured to be small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest frame to broadcast, and what a value takes in it apart from its text.
BROADCAST_BYTES = 64 * 1024 * 1024
VALUE_BYTES = 16


def measured_bytes(df: DataFrame) -> int:
    """Bytes the frame takes in memory: its text as it is and a flat amount per value.

    One pass that aggregates on the executors. Meant for filtered scans and written frames; the
    rest of a costly plan would be computed for this alone.
    """
    return df.agg(total_bytes(df).alias("bytes")).first().bytes


def total_bytes(df: DataFrame) -> Column:
    """The aggregate that measures a frame, or groups of its rows."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType | T.BinaryType)]
    total = F.count(F.lit(1)) * (VALUE_BYTES * len(df.columns))
    for name in text:
        total = total + F.coalesce(F.sum(F.octet_length(name)), F.lit(0))
    return total


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the frame takes at most ``limit`` bytes (BROADCAST_BYTES by default)."""
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def broadcast_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Hint a broadcast if the frame is small, else leave the join strategy to the optimizer."""
    return F.broadcast(df) if is_small(df, limit) else df


def unless_large(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Keep the optimizer from broadcasting a frame of more than ``limit`` bytes (BROADCAST_BYTES by
    default): it goes by the size of files, in which a key column takes a fraction of its bytes in memory."""
    return df if is_small(df, limit) else df.hint("merge")
