"""Mixing sources to target weights, in blocks of equal numbers of words.

A source's documents, in a fixed pseudorandom order, are one stream of words that is packed into
blocks. The mix is a sequence of output shards of ``SLOTS`` blocks. Each output shard draws how many
of its slots every source gets: multinomial counts, given that the totals over all shards are the
targets. Halving the range of shards again and again, each draw seeded by its place, lets a task find
its own shard's counts, and how many slots of a source come before, without the other shards.

Slot ``k`` of a source is block ``permute(k)`` of it: every pass over the source's blocks follows a
pseudorandom permutation of its own, so no block is taken more often than the passes. Slots and
blocks are joined by (source, block index), which is unique in each pass: a hot source spreads like
any other. Nothing depends on partitions, so reruns agree.

Defined results: a missing or empty text has size 0 and is never taken. Missing sources are one
source, last in order. Repeated rows are documents of their own; a missing doc_id is ordered first.
The number of sources is bounded by ``MAX_SOURCES``; a larger one is an error. Columns named
``repeat`` and such of the input do not matter: only named ones are read, and ``mixed_documents``
returns the input's columns.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from guildmart.llm.common import Frames
from guildmart.sources.warehouse import written

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_WORDS = 128
SLOTS = 4096
BUCKETS, BUCKET_WORDS = 1024, 50_000_000  # a bucket's tasks sort so many words, if there are that many
SEED = 17
MAX_SOURCES = 100_000


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: list[int], weights: list[float], max_repeat: int = MAX_REPEAT) -> list[float]:
    """Shares of all sizes by weight; what a source cannot take is shared again by weight."""
    result = [0.0] * len(sizes)
    open_, rest = list(range(len(sizes))), float(sum(sizes))
    while open_:
        unit = rest / sum(weights[i] for i in open_)
        over = [i for i in open_ if unit * weights[i] > max_repeat * sizes[i]]
        for i in over or open_:
            result[i] = float(max_repeat * sizes[i]) if over else unit * weights[i]
        if not over:
            break
        rest = max(0.0, rest - sum(result[i] for i in over))
        open_ = [i for i in open_ if i not in set(over)]
    return result


def _rng(*place: int) -> np.random.Generator:
    return np.random.Generator(np.random.PCG64(list(place)))


def _left_counts(totals: np.ndarray, left_slots: int, place: tuple[int, ...]) -> np.ndarray:
    """How many of ``left_slots`` slots each source gets, drawn without replacement from the totals.

    Source after source, given those before: a normal draw with the mean and the variance of the
    hypergeometric one, rounded and kept to its range, at every size alike.
    """
    draws = _rng(*place).standard_normal(len(totals)).tolist()
    rest, left, counts = int(totals.sum()), left_slots, []
    for n, draw in zip(totals.tolist(), draws):
        others = rest - n
        share = left / rest if rest else 0.0
        spread = math.sqrt(max(0.0, n * share * (1 - share) * others / max(1, rest - 1)))
        count = min(max(round(n * share + spread * draw), left - others, 0), n, left)
        counts.append(count)
        rest, left = others, left - count
    return np.array(counts, dtype=np.int64)


def shard_counts(slots: np.ndarray, shard: int, shards: int, per_shard: int, seed: int = SEED):
    """(counts, first): each source's slots in the output shard and in all shards before it."""
    totals, first = slots.astype(np.int64), np.zeros(len(slots), dtype=np.int64)
    low, high = 0, shards
    while high - low > 1:
        mid = (low + high) // 2
        left = _left_counts(totals, min(int(totals.sum()), (mid - low) * per_shard), (seed, low, high))
        if shard < mid:
            totals, high = left, mid
        else:
            totals, first, low = totals - left, first + left, mid
    return totals, first


def _mixed(x: np.ndarray, keys: list[int], half: int) -> np.ndarray:
    """A bijection of [0, 4**half): Feistel rounds on two halves of ``half`` bits."""
    mask, bits = np.uint64((1 << half) - 1), np.uint64(half)
    high, low = x >> bits, x & mask
    for key in keys:
        word = (low + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        word = (word ^ (word >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        high, low = low, high ^ ((word >> np.uint64(32)) & mask)
    return (high << bits) | low


def permute(x: np.ndarray, n: int, *key: int) -> np.ndarray:
    """Places of ``x`` under a pseudorandom permutation of range(n) that ``key`` chooses."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    text = ",".join(map(str, key)).encode()
    keys = [int.from_bytes(hashlib.sha256(text + bytes([i])).digest()[:7], "big") for i in range(6)]
    out = _mixed(x.astype(np.uint64), keys, half)
    while (outside := out >= n).any():  # walk the cycle back into the range
        out[outside] = _mixed(out[outside], keys, half)
    return out.astype(np.int64)


class Mix:
    """The packed documents, the sources' targets and the drawn slots of one mix.

    ``size`` gives a document's words and ``digest`` a hash of its text, by default those of ``text``. ``sized`` has one row per document:
    ``row`` with the columns given, ``source_no``, ``size`` and ``offset``, the
    document's place in its source's stream. (source_no, offset) names a document of size over 0.
    """

    def __init__(
        self,
        docs: DataFrame,
        size: Column | None = None,
        digest: Column | None = None,
        weights: tuple[float, ...] = WEIGHTS,
        block_words: int = BLOCK_WORDS,
        seed: int = SEED,
        slots_per_shard: int = SLOTS,
    ) -> None:
        self.spark, self.block, self.seed, self.per_shard = docs.sparkSession, block_words, seed, slots_per_shard
        names = docs.columns
        own = digest if digest is not None else F.xxhash64("text")
        rows = docs.select(
            F.struct(*names).alias("row"), "doc_id", "source", (n_words() if size is None else size).alias("size"), own.alias("digest")
        )
        rows = written(rows) if "text" not in names else rows
        counted = rows.select("doc_id", "source", "size")
        found = counted.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
        if len(found) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        found.sort(key=lambda r: (r.source is None, r.source or ""))
        self.sizes = [int(r.size) for r in found]
        self.targets = targets(self.sizes, [float(weights[i % len(weights)]) for i in range(len(found))])
        self.sources = self.spark.createDataFrame(
            [(i, r.source, s, t) for i, (r, s, t) in enumerate(zip(found, self.sizes, self.targets))],
            "source_no int, source string, source_size bigint, target double",
        )
        self.blocks = [-(-s // block_words) for s in self.sizes]
        # By the mean size of a source's blocks, as the last one is not full: a capped source gets whole passes.
        sized = zip(self.targets, self.blocks, self.sizes)
        self.slots = [min(round(t * b / s), MAX_REPEAT * b) if s else 0 for t, b, s in sized]
        self.sized = self._packed(rows)

    def _packed(self, rows: DataFrame) -> DataFrame:
        """Offsets from exact sums over (source, bucket) cells and a window within each cell."""
        buckets = max(BUCKETS, sum(self.sizes) // BUCKET_WORDS)
        numbers = F.broadcast(self.sources.select("source_no", F.col("source").alias("_s")))
        keyed = rows.join(numbers, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        keyed = keyed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "digest", F.lit(self.seed)), F.lit(buckets)))
        before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        # A small table: sources times buckets.
        cells = keyed.groupBy("source_no", "bucket").agg(F.sum("size").alias("sum")).select(
            "source_no", "bucket", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("start")
        )
        inside = (
            Window.partitionBy("source_no", "bucket").orderBy("doc_id", "digest", "size").rowsBetween(Window.unboundedPreceding, -1)
        )
        offset = F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
        placed = keyed.join(cells, ["source_no", "bucket"]).withColumn("offset", offset)
        return written(placed.select("row", "source_no", "size", "offset"))

    def segments(self) -> DataFrame:
        """(source_no, block, offset, from_word, n_words): what each block holds of which document."""
        block = F.lit(self.block)
        end = F.col("offset") + F.col("size")
        low = F.greatest("offset", F.col("block") * block)
        return (
            self.sized.where("size > 0")
            .select(
                "source_no",
                "offset",
                "size",
                F.explode(
                    F.sequence(F.floor(F.col("offset") / block), F.floor((end - 1) / block))
                ).alias("block"),
            )
            .select(
                "source_no",
                "block",
                "offset",
                (low - F.col("offset")).alias("from_word"),
                (F.least(end, (F.col("block") + 1) * block) - low).alias("n_words"),
            )
        )

    def slot_blocks(self) -> DataFrame:
        """(out_shard, slot, source_no, block): which block fills each slot of each output shard."""
        slots, blocks = np.array(self.slots, dtype=np.int64), list(self.blocks)
        total, per_shard, seed = int(slots.sum()), self.per_shard, self.seed
        shards = -(-total // per_shard)

        def draw(frames: Frames) -> Frames:
            for frame in frames:
                for shard in frame.id.tolist():
                    counts, first = shard_counts(slots, shard, shards, per_shard, seed)
                    source = np.repeat(np.arange(len(slots)), counts)
                    block = np.empty(len(source), dtype=np.int64)
                    for s in np.flatnonzero(counts).tolist():
                        k = np.arange(first[s], first[s] + counts[s])
                        chosen = np.empty(len(k), dtype=np.int64)
                        for turn in np.unique(k // blocks[s]).tolist():
                            at = k // blocks[s] == turn
                            chosen[at] = permute(k[at] % blocks[s], blocks[s], seed, s, turn)
                        block[source == s] = chosen
                    order = _rng(seed, shard).permutation(len(source))
                    yield pd.DataFrame(
                        {"out_shard": shard, "slot": np.arange(len(source)), "source_no": source[order], "block": block[order]}
                    )

        parts = max(1, min(shards, 4 * self.spark.sparkContext.defaultParallelism))
        return self.spark.range(0, shards, 1, parts).mapInPandas(
            draw, "out_shard bigint, slot bigint, source_no int, block bigint"
        )

    def rows(self) -> DataFrame:
        """The mix: every slot's segments, as (out_shard, slot, source_no, offset, from_word, n_words)."""
        # Both sides grow with the data; the slots' number cannot be estimated, so the join is named.
        return self.slot_blocks().join(self.segments().hint("merge"), ["source_no", "block"]).drop("block")

    def taken(self) -> DataFrame:
        """(row, source_no, size, offset, taken): words the mix takes of each document, repeats counted."""
        sums = self.rows().groupBy("source_no", "offset").agg(F.sum("n_words").alias("taken"))
        some = self.sized.where("size > 0").join(sums, ["source_no", "offset"], "left")
        none = self.sized.where("size = 0").withColumn("taken", F.lit(None).cast("bigint"))
        return some.unionByName(none).withColumn("taken", F.coalesce("taken", F.lit(0)))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """What the mix takes, with the columns of ``docs``: a row per document and time it is taken.

    The text of the r-th row is the document's text in the blocks taken at least r times, with the
    white space between their words; a document taken whole keeps its text as it is.
    """
    mix = Mix(docs, **options)
    pieces = (
        mix.rows()
        .groupBy("source_no", "offset", "from_word", "n_words")
        .agg(F.count(F.lit(1)).alias("times"))
        .groupBy("source_no", "offset")
        .agg(F.sort_array(F.collect_list(F.struct("from_word", "n_words", "times"))).alias("pieces"))
    )
    taken = mix.sized.where("size > 0").join(pieces, ["source_no", "offset"])

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series, sizes: pd.Series, all_pieces: pd.Series) -> pd.Series:
        return pd.Series([cuts(t, s, p) for t, s, p in zip(texts, sizes, all_pieces)])

    texts = taken.withColumn("_text", F.explode(cut(F.col("row.text"), "size", "pieces")))
    own = [F.col("_text").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return texts.select(*own)


def cuts(text: str, size: int, pieces) -> list[str]:
    """The texts of a document's rows in the mix, from its pieces (first word, words, times taken)."""
    result, spans = [], None
    for turn in range(max(p["times"] for p in pieces)):
        wanted = [(p["from_word"], p["n_words"]) for p in pieces if p["times"] > turn]
        if sum(n for _, n in wanted) == size:
            result.append(text)
            continue
        spans = spans or word_spans(text)
        merged: list[list[int]] = []
        for start, n in wanted:
            if merged and merged[-1][1] == start:
                merged[-1][1] += n
            else:
                merged.append([start, start + n])
        result.append("\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in merged))
    return result


def word_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
