"""Merkle manifest of a document table, with one version of the tree per changed document.

Every row is a leaf. The leaves of one ``lang``, in order of doc_id, are the bottom of a tree in which
every ``FANOUT`` consecutive nodes have one parent; the languages' roots are the bottom of a last tree.
Digests are lower-case hex SHA-256, of concatenated hex digests above the leaves.

Trees are built in aligned blocks of ``FANOUT ** LEVELS`` nodes, each a task's group of bounded size
whatever language holds the rows: a block's top is a node of the next, smaller table, until every
language has one. Rows get their places by a range partitioning that may cut a language, or even rows
of one doc_id, anywhere: counts per partition and language, summed in order, say where each begins.

A changed document makes a version of the tree by path copying. Inside its block the version copies
the ancestors of its leaf and shares all other nodes (``PersistentTree``); the version's block top then
goes on through the upper trees, whose untouched nodes beside its path come from one row per block.

Defined results: a missing value is the byte ``-`` in its leaf; missing doc_ids come first within
their language and count as unchanged; a missing lang is a language of its own, before all others.
Rows of one doc_id are leaves of their own, in order of their digests. An empty table has no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from guildmart.sources.warehouse import written

FANOUT, LEVELS = 8, 3
PARTS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """The digest of a row, or of the row with another text."""
    values = [F.col(c) for c in PARTS[:-1]] + [F.col("text") if text is None else text]
    return F.sha2(F.concat(*map(_field, values)), 256)


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def language_key(lang: Column) -> Column:
    """A text that orders languages: a missing one first, the others by their UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


class PersistentTree:
    """Nodes of ``FANOUT`` children, appended and never changed; a version is its root's number."""

    def __init__(self, leaves: list[str], levels: int) -> None:
        self.digests, self.children = list(leaves), [()] * len(leaves)
        self.levels, level = levels, list(range(len(leaves)))
        for _ in range(levels):
            level = [self._add(tuple(level[i : i + FANOUT])) for i in range(0, len(level), FANOUT)]
        (self.root,) = level

    def _add(self, children: tuple[int, ...]) -> int:
        self.digests.append(digest(*(self.digests[c] for c in children)))
        self.children.append(children)
        return len(self.digests) - 1

    def path(self, root: int, place: int) -> list[tuple[int, int]]:
        """(node, which of its children) from the root to the parent of the leaf at this place."""
        steps = []
        for level in reversed(range(self.levels)):
            turn = place // FANOUT**level % FANOUT
            steps.append((root, turn))
            root = self.children[root][turn]
        return steps

    def changed(self, root: int, place: int, leaf_digest: str) -> list[int]:
        """The version with another leaf: the nodes it copies, from the leaf to its root."""
        self.digests.append(leaf_digest)
        self.children.append(())
        copies = [len(self.digests) - 1]
        for node, turn in reversed(self.path(root, place)):
            old = self.children[node]
            copies.append(self._add((*old[:turn], copies[-1], *old[turn + 1 :])))
        return copies

    def beside(self, root: int, place: int) -> list[tuple[str, str]]:
        """The digests left and right of the path, level by level from the leaf up."""
        sides = []
        for node, turn in reversed(self.path(root, place)):
            run = [self.digests[c] for c in self.children[node]]
            sides.append(("".join(run[:turn]), "".join(run[turn + 1 :])))
        return sides


def fold(leaf_digest: str, sides: list[tuple[str, str]]) -> list[str]:
    """The digests from a leaf to the root along a path, the leaf included."""
    steps = [leaf_digest]
    for left, right in sides:
        steps.append(digest(left, steps[-1], right))
    return steps


def block_levels(total: int, most: int = LEVELS) -> int:
    """Levels inside the blocks of a tree of ``total`` nodes; the last block's tree ends at its root."""
    levels = 0
    while levels < most and total > 1:
        total, levels = -(-total // FANOUT), levels + 1
    return levels


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, their place within ``key`` by ``order``, and ``total``, the key's rows.

    Written in ranges first, as the places of a range's rows must not move when a task is repeated.
    Equal rows may be cut apart by their place in the input, so no value fills a range.
    """
    own = rows.columns
    ends = ["key", *order, "_row"]
    ranged = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*ends).sortWithinPartitions(*ends)
    ranged = written(ranged.select(*own, F.monotonically_increasing_id().alias("_at")))
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    ranged = ranged.select(*own, part.alias("_part"), at.alias("_at"))
    before = Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range and key in it: as many as there are ranges and keys.
    cells = ranged.groupBy("key", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    cells = cells.select(
        "key",
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("key")).alias("total"),
    )
    placed = ranged.join(cells, ["key", "_part"])
    return placed.select(*own, (F.col("_at") + F.col("_shift")).alias("idx"), "total")


def _block(levels: int) -> Column:
    return F.floor(F.col("idx") / F.lit(FANOUT**levels)).cast("bigint")


def _tops(nodes: DataFrame, levels: int) -> DataFrame:
    """The tops of the blocks of ``nodes`` as nodes of the next table: (key, idx, total, digest)."""

    def top(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("idx")
        total = int(frame.total.iloc[0])
        tree = PersistentTree(frame.digest.tolist(), block_levels(total, levels))
        above = -(-total // FANOUT**levels)
        return pd.DataFrame({"key": [key[0]], "idx": [key[1]], "total": [above], "digest": [tree.digests[tree.root]]})

    rows = nodes.select("key", "idx", "total", "digest", _block(levels).alias("block"))
    return rows.groupBy("key", "block").applyInPandas(top, "key string, idx bigint, total bigint, digest string")


def _grown(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The tables above ``nodes``, each of the keys not finished below, and the keys' roots (key, digest)."""
    tables, roots = [nodes], []
    while True:
        above = written(_tops(tables[-1], levels))
        roots.append(above.where("total = 1").select("key", "digest"))
        more = above.where("total > 1")
        if more.isEmpty():  # after one round per ``levels`` levels of the largest tree
            break
        tables.append(more)
    done = roots[0]
    for some in roots[1:]:
        done = done.unionByName(some)
    return tables, done


_ABOVE = "key string, idx bigint, lefts array<string>, rights array<string>, subroot string, root string"


def _within(frame: pd.DataFrame, above: pd.DataFrame, levels: int):
    """A block's tree, its rows in order, and the path above it."""
    frame = frame.sort_values("idx")
    tree = PersistentTree(frame.digest.tolist(), block_levels(int(frame.total.iloc[0]), levels))
    up = above.iloc[0]
    return frame, tree, list(zip(up.lefts, up.rights)), up


def _beside(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """The path above each of ``nodes``, from the paths above their blocks."""

    def beside(frame: pd.DataFrame, paths: pd.DataFrame) -> pd.DataFrame:
        frame, tree, upper, up = _within(frame, paths, levels)
        sides = [tree.beside(tree.root, i) + upper for i in range(len(frame))]
        return pd.DataFrame(
            {
                "key": frame.key,
                "idx": frame.idx,
                "lefts": [[left for left, _ in s] for s in sides],
                "rights": [[right for _, right in s] for s in sides],
                "subroot": up.subroot,
                "root": up.root,
            }
        )

    rows = nodes.withColumn("block", _block(levels)).groupBy("key", "block")
    return rows.cogroup(above.groupBy("key", "idx")).applyInPandas(beside, _ABOVE)


def _paths(tables: list[DataFrame], ends: DataFrame, levels: int) -> DataFrame:
    """The paths above the blocks of ``tables[0]``; ``ends`` has those above each key's root, as idx 0."""
    above = ends
    for table in reversed(tables[1:]):
        # Blocks of the table below are this table's nodes; finished keys have the one block 0.
        finished = ends.join(table.select("key").distinct(), "key", "left_anti")
        above = written(_beside(table, above.join(table.select("key").distinct(), "key", "left_semi"), levels).unionByName(finished))
    return above


@dataclass(frozen=True)
class Manifest:
    """The built tree: its leaves with their places, and the path above each block of leaves."""

    leaves: DataFrame
    above: DataFrame
    levels: int = LEVELS

    def roots(self) -> DataFrame:
        """(key, subroot, root), a row per language."""
        return self.above.where("idx = 0").select("key", "subroot", "root")

    def versions(self) -> DataFrame:
        """One row per leaf: its proof, the root recomputed with its changed or else its own digest, and
        ``copied``, the digests of the nodes that its version of the tree copied, from leaf to root."""

        levels = self.levels

        def verify(frame: pd.DataFrame, paths: pd.DataFrame) -> pd.DataFrame:
            frame, tree, upper, up = _within(frame, paths, levels)
            proofs, folded, copied = [], [], []
            for i, (own, other) in enumerate(zip(frame.digest, frame.changed)):
                inside = tree.beside(tree.root, i)
                proofs.append(digest(*(left + right for left, right in inside + upper)))
                if isinstance(other, str):
                    steps = [tree.digests[n] for n in tree.changed(tree.root, i, other)]
                    copied.append(steps + fold(steps[-1], upper)[1:])
                    folded.append(copied[-1][-1])
                else:
                    copied.append(None)
                    folded.append(fold(own, inside + upper)[-1])
            return pd.DataFrame(
                {
                    "doc_id": frame.doc_id.astype("Int64"),
                    "leaf": frame.digest,
                    "subroot": up.subroot,
                    "root": up.root,
                    "proof_sha256": proofs,
                    "folded_root": folded,
                    "verified": [f == up.root for f in folded],
                    "copied": copied,
                }
            )

        rows = self.leaves.withColumn("block", _block(levels)).groupBy("key", "block")
        return rows.cogroup(self.above.groupBy("key", "idx")).applyInPandas(
            verify,
            "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
            "verified boolean, copied array<string>",
        )


def build(docs: DataFrame, changes: Column, new_text: Column, levels: int = LEVELS) -> Manifest:
    """The manifest of ``docs``; where ``changes`` holds, a row's version has ``new_text`` for its text."""
    changed = F.when(F.coalesce(changes, F.lit(False)), leaf(new_text))
    rows = docs.select(
        language_key(F.col("lang")).alias("key"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf().alias("digest"),
        changed.alias("changed"),
    )
    leaves = written(numbered(written(rows), ["doc_id", "digest"]))
    tables, subroots = _grown(leaves, levels)
    # The languages' roots, in order of the languages, under one key.
    named = subroots.select(F.lit("").alias("key"), F.col("key").alias("lang_key"), "digest")
    last = written(numbered(named, ["lang_key"]))
    upper, root = _grown(last, levels)
    no_side, first = F.array().cast("array<string>"), F.lit(0).cast("bigint").alias("idx")
    start = root.select("key", first, no_side.alias("lefts"), no_side.alias("rights"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    over = _beside(last, _paths(upper, start, levels), levels).select("idx", "lefts", "rights", "root")
    named = last.select("idx", F.col("lang_key").alias("key"), F.col("digest").alias("subroot"))
    ends = over.join(named, "idx").select("key", first, "lefts", "rights", "subroot", "root")
    return Manifest(leaves, _paths(tables, written(ends), levels), levels)


def tampered(docs: DataFrame, levels: int = LEVELS) -> Manifest:
    """The manifest with the versions in which every third document, by crc32 of its id, is lower-cased."""
    every_third = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    return build(docs, every_third, lowered(F.col("text")), levels)
