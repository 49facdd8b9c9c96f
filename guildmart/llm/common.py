"""What several operators share: tables, hot keys and words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A key with more than 1/HOT_SHARE of all rows is hot, so there are at most HOT_SHARE hot keys.
HOT_SHARE = 4096
# In orders, a missing doc_id comes after all others.
LAST_ID = 2**63 - 1

# Upper-case ASCII to lower case, other ASCII characters than letters and digits to spaces.
_WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

Frames = Iterator[pd.DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8(column: str = "text"):
    """The text as UTF-8 bytes, empty if missing."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def ordered_id():
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID))


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.translate(_WORD_TABLE).split()


def _planes(values: np.ndarray, dtype: str) -> bytes:
    """The bytes of equal weight stand together, which makes small numbers small."""
    raw = np.ascontiguousarray(values, dtype=dtype)
    return np.ascontiguousarray(raw.view(np.uint8).reshape(-1, raw.dtype.itemsize).T).tobytes()


def _values(raw: np.ndarray, dtype: str) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


# One of each per worker: making them costs more than a small message.
_PACKER, _UNPACKER = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(values: np.ndarray, dtype: str) -> bytes:
    return _PACKER.compress(_planes(values, dtype))


def unpack(blob: bytes, dtype: str) -> np.ndarray:
    return _values(np.frombuffer(_UNPACKER.decompress(blob), dtype=np.uint8), dtype)


def pack_all(arrays: list[np.ndarray], dtypes: list[str]) -> bytes:
    """Several arrays in one blob, which begins with their lengths."""
    lengths = np.array(list(map(len, arrays)), dtype="<u4").tobytes()
    return _PACKER.compress(lengths + b"".join(map(_planes, arrays, dtypes)))


def unpack_all(blob: bytes, dtypes: list[str]) -> list[np.ndarray]:
    raw = np.frombuffer(_UNPACKER.decompress(blob), dtype=np.uint8)
    at, arrays = 4 * len(dtypes), []
    for n, dtype in zip(raw[:at].view("<u4").tolist(), dtypes):
        size = n * np.dtype(dtype).itemsize
        arrays.append(_values(raw[at : at + size], dtype))
        at += size
    return arrays


def hot_keys(counts: DataFrame, rows: int, count: str = "n") -> DataFrame:
    """The rows of ``counts`` (one per key) whose key has over 1/HOT_SHARE of ``rows`` rows."""
    return counts.where(F.col(count) * HOT_SHARE > rows)


def join_keyed(rows: DataFrame, keyed: DataFrame, on: list[str], how: str, total: int, count: str):
    """Join ``rows`` to ``keyed``, which has one row per key and the key's number of rows in ``count``.

    The at most HOT_SHARE hot keys are broadcast, so no key brings more than 1/HOT_SHARE of the rows
    into a shuffle. Keys must not be NULL; ``how`` is inner or left.
    """
    hot = F.col(count) * HOT_SHARE > total
    first = rows.join(F.broadcast(keyed.where(hot).drop(count).withColumn("_hot", F.lit(True))), on, "left")
    found = first.where(F.col("_hot")).drop("_hot")
    rest = rows.join(F.broadcast(keyed.where(hot).select(*on)), on, "left_anti")
    return found.unionByName(rest.join(keyed.where(~hot).drop(count), on, how))
