"""SimHash near-duplicates by vantage-point trees.

Two fingerprints that differ in at most ``r`` of 64 bits differ in at most ``r // 2`` bits of the
lower or of the upper 32 bits. The Hamming distance of one half is a metric too, and its small
radius prunes well, so there is one forest per half. The top of a half's tree is fitted on a bounded
sample of the distinct fingerprints and broadcast; its leaves are the shards. Every fingerprint goes
to the leaf it falls into and, by the triangle bound, also as a visitor to every later leaf that its
ball reaches into. Each shard builds its own vantage-point tree and searches it with its points and
visitors; hits are verified over all 64 bits. So every pair within ``r`` is met in a shard.

A shard returns a spanning forest of what it linked, not its pairs, and components are joined across
shards by min-label propagation with pointer jumping, round by round in written tables.

Defined results: a missing or empty text has fingerprint 0 and links like any other. Rows with equal
doc_id are separate texts. A missing doc_id is never the smallest of a component; a component of
such rows alone has component_id NULL. Other columns of the input are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guildmart.llm.common import Frames, join_keyed, ordered_id, utf8
from guildmart.sources.warehouse import written

SHINGLE_WORDS = 3
MAX_BITS = 3
SHARD_POINTS = 20_000  # distinct fingerprints wanted in a shard
SAMPLE_PER_SHARD = 32  # of them in the sample that the top of the tree is fitted on
LEAF_POINTS = 128
VANTAGE_TRIES = 8
HALVES = (np.uint64(0x00000000FFFFFFFF), np.uint64(0xFFFFFFFF00000000))
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if more than half of the shingles' XXH64 (seed 42) have it."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], dtype=np.uint64)
    # Counts of up to 255 hashes fit into the eight byte lanes of one integer.
    starts = np.arange(0, len(hashes), 255)
    counts = np.empty(64, dtype=np.int64)
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, starts)
        counts[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, id_type: str = "bigint") -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed integer."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select(F.col("doc_id").cast(id_type).alias("doc_id"), of(utf8()).alias("fp"))


def distance(points: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & mask).astype(np.int64)


@dataclass
class VantageTree:
    """Nodes with a vantage point, a radius and two children; ``leaves[i]`` are a leaf's points.

    Points within the radius are in the inner child. A leaf is written as ``-1 - leaf``.
    """

    mask: np.uint64
    vantage: list[np.uint64]
    radius: list[int]
    inner: list[int]
    outer: list[int]
    leaves: list[np.ndarray]
    root: int = 0

    @classmethod
    def fit(cls, points: np.ndarray, mask: np.uint64, leaf_points: int) -> VantageTree:
        tree = cls(mask, [], [], [], [], [])
        tree.root = tree._grow(points, np.arange(len(points)), leaf_points)
        return tree

    def _grow(self, points: np.ndarray, index: np.ndarray, leaf_points: int) -> int:
        split = self._split(points, index) if len(index) > leaf_points else None
        if split is None:
            self.leaves.append(index)
            return -len(self.leaves)
        vantage, radius, inside = split
        node = len(self.vantage)
        self.vantage.append(vantage)
        self.radius.append(radius)
        self.inner.append(0)
        self.outer.append(0)
        self.inner[node] = self._grow(points, index[inside], leaf_points)
        self.outer[node] = self._grow(points, index[~inside], leaf_points)
        return node

    def _split(self, points: np.ndarray, index: np.ndarray):
        """The most even of a few vantage points' splits, or None if none splits the points."""
        best = None
        for at in np.linspace(0, len(index) - 1, VANTAGE_TRIES).astype(int):
            d = distance(points[index], points[index[at]], self.mask)
            for radius in {int(np.median(d)), int(np.median(d)) - 1}:
                inside = d <= radius
                uneven = abs(2 * int(inside.sum()) - len(index))
                if 0 < inside.sum() < len(index) and (best is None or uneven < best[0]):
                    best = (uneven, points[index[at]], radius, inside)
        return best and best[1:]

    def visits(self, points: np.ndarray, reach: int):
        """Yield (leaf, indexes of the points whose ball of radius ``reach`` meets the leaf)."""
        stack = [(self.root, np.arange(len(points)))]
        while stack:
            node, index = stack.pop()
            if not len(index):
                continue
            if node < 0:
                yield -1 - node, index
                continue
            d = distance(points[index], self.vantage[node], self.mask)
            stack.append((self.inner[node], index[d - reach <= self.radius[node]]))
            stack.append((self.outer[node], index[d + reach > self.radius[node]]))


def min_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node it is linked to by the edges, directly or not."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before, label.copy())
        label = label[label]
        if (label == before).all():
            break
    return label


def _spanning(near: np.ndarray, rows: np.ndarray, cols: np.ndarray):
    """Edges that link what the boolean matrix links: at most one per row and column."""
    hit_rows, hit_cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    near = near[np.ix_(hit_rows, hit_cols)]
    label = np.arange(len(hit_cols))
    while True:
        row_label = np.where(near, label[None, :], len(hit_cols)).min(axis=1, initial=len(hit_cols))
        new = np.minimum(label, np.where(near, row_label[:, None], len(hit_cols)).min(axis=0, initial=len(hit_cols)))
        if (new == label).all():
            break
        label = new
    centre = cols[hit_cols]
    return (
        np.concatenate([rows[hit_rows], centre]),
        np.concatenate([centre[row_label], centre[label]]),
    )


def link_points(home: np.ndarray, visitors: np.ndarray, mask: np.uint64, max_bits: int, reach: int):
    """Pairs (point, root) that link the points and visitors of a shard as their distances do."""
    points = np.concatenate([home, visitors])
    tree = VantageTree.fit(home, mask, LEAF_POINTS)
    a, b = [np.empty(0, dtype=int)], [np.empty(0, dtype=int)]
    for leaf, index in tree.visits(points, reach):
        cols = tree.leaves[leaf]
        for start in range(0, len(index), 4096):
            rows = index[start : start + 4096]
            near = np.bitwise_count(points[rows][:, None] ^ home[cols][None, :]) <= max_bits
            near &= rows[:, None] != cols[None, :]
            if near.any():
                x, y = _spanning(near, rows, cols)
                a.append(x)
                b.append(y)
    label = min_labels(len(points), np.concatenate(a), np.concatenate(b))
    linked = np.flatnonzero(label != np.arange(len(points)))
    return points[linked], points[label[linked]]


def links(distinct: DataFrame, n: int, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all pairs within reach."""
    shards = max(1, math.ceil(n / SHARD_POINTS))
    share = min(1.0, shards * SAMPLE_PER_SHARD / max(1, n))
    # A fixed pseudorandom choice, so that a recomputed task sees the same tree.
    chosen = F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    sample = np.sort(np.array([r.fp for r in distinct.where(chosen).collect()], dtype=np.int64))
    reach = max_bits // len(HALVES)
    per_leaf = max(1, math.ceil(len(sample) / shards))
    tops = [VantageTree.fit(sample.view(np.uint64), mask, per_leaf) for mask in HALVES]
    top = distinct.sparkSession.sparkContext.broadcast(tops)

    def deal(frames: Frames) -> Frames:
        for frame in frames:
            points = frame.fp.to_numpy(dtype=np.int64).view(np.uint64)
            for half, tree in enumerate(top.value):
                own = np.zeros(len(points), dtype=np.int64)
                for leaf, index in tree.visits(points, 0):
                    own[index] = leaf
                for leaf, index in tree.visits(points, reach):
                    index = index[own[index] <= leaf]
                    yield pd.DataFrame(
                        {"half": half, "leaf": leaf, "fp": points[index].view(np.int64), "home": own[index] == leaf}
                    )

    def search(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        points = frame.fp.to_numpy(dtype=np.int64).view(np.uint64)
        home = frame.home.to_numpy(dtype=bool)
        a, b = link_points(np.sort(points[home]), points[~home], HALVES[int(key[0])], max_bits, reach)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.select("fp").mapInPandas(deal, "half int, leaf int, fp bigint, home boolean")
    return dealt.groupBy("half", "leaf").applyInPandas(search, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the written ``edges``; label is the smallest node reachable.

    Each round takes the smallest label of all neighbours, then the label's own label. Rounds are
    written, so a lost executor costs no round again.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")))
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("label").alias("seen"))
        near = both.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        lower = written(
            labels.join(near, "node", "left").select("node", "label", F.least("label", "seen").alias("low"))
        )
        up = lower.select(F.col("node").alias("low"), F.col("low").alias("up"))
        new = written(lower.join(up, "low").select("node", "label", F.least("low", "up").alias("new")))
        changed = new.where(F.col("new") != F.col("label")).limit(1).count()
        labels = new.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_type: str = "bigint"
) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest doc_id reachable."""
    rows = written(fingerprints(docs, width, id_type))
    distinct = written(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")))
    size = distinct.agg(F.count(F.lit(1)).alias("fps"), F.sum("n").alias("docs")).first()
    edges = written(links(distinct, size.fps, max_bits))
    labels = components(edges).withColumnRenamed("node", "fp")
    linked = distinct.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    lowest = linked.where(F.col("label") != F.col("fp")).groupBy("label").agg(F.min("first_id").alias("other_id"))
    roots = linked.select("fp", "n", "first_id", "label").join(
        # The root's own smallest id counts too.
        lowest.join(distinct.select(F.col("fp").alias("label"), F.col("first_id").alias("root_id")), "label"),
        "label",
        "left",
    )
    named = roots.select(
        "fp", "n", F.coalesce(F.least("other_id", "root_id"), "first_id").alias("component_id")
    )
    return join_keyed(rows, written(named), ["fp"], "inner", size.docs or 0, "n").select(
        "doc_id", "fp", "component_id"
    )


def one_of_each(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of linked documents, with its columns: that with the smallest doc_id.

    Of several with that doc_id, or of a group without any, the one with the smallest hash of its text
    stays, so rows of one doc_id whose texts are not linked all stay. Of rows with equal doc_id and text
    the one with the smallest other columns stays.
    """
    key = F.struct(ordered_id().alias("id"), F.xxhash64(utf8()).alias("text_key"))
    named = near_duplicates(docs.select(key.alias("doc_id"), "text"), width, max_bits, "struct<id:bigint,text_key:bigint>")
    gone = written(named.where(F.col("doc_id") != F.col("component_id")).select("doc_id.*").distinct())
    keyed = docs.select(F.struct(*docs.columns).alias("row"), ordered_id().alias("id"), F.xxhash64(utf8()).alias("text_key"))
    kept = keyed.join(gone, ["id", "text_key"], "left_anti")
    again = written(keyed.groupBy("id", "text_key").count().where("count > 1").select("id", "text_key"))
    own = [F.col("row")[c].alias(c) for c in docs.columns]
    if not again.limit(1).count():
        return kept.select(*own)
    one = kept.join(again, ["id", "text_key"], "left_semi").groupBy("id", "text_key").agg(F.min("row").alias("row"))
    return kept.join(again, ["id", "text_key"], "left_anti").select(*own).unionByName(one.select(*own))
