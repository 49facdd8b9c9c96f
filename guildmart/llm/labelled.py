"""Bounded samples of labelled documents, the same at every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FULL = 1 << 30


def remainder(column: str, n: int) -> Column:
    """crc32(doc_id as text) mod n; a missing doc_id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(n)).cast("int")


def sample(docs: DataFrame, labels: DataFrame, label: str, chosen: Column, bound: int, most_bytes: int) -> DataFrame:
    """(doc_id, text, label) of labelled documents for fitting, about ``bound`` per label at most.

    ``chosen`` is a condition on ``doc_id``. A pseudorandom share of each label's documents is taken,
    by the hash of doc_id, so that about ``bound`` remain; texts of over ``most_bytes`` are left out.
    A document labelled twice counts once per label. Missing ids, labels and texts are not taken.
    """
    named = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    named = named.where(chosen & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).distinct()
    counts = {r.label: r["count"] for r in named.groupBy("label").count().collect()}
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col("label") == value, int(min(1.0, bound / n) * FULL)).otherwise(share)
    picked = named.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(FULL)) < share)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    texts = texts.where(F.octet_length("text") <= most_bytes)
    # ``picked`` has about 2 * bound rows of 12 bytes at most, whatever the size of the data.
    return texts.join(F.broadcast(picked), "doc_id")
