"""Benchmark decontamination: BM25 with block-max pruning, then overlap of question and answer.

Benchmark items are indexed, passages are the queries. A weight is an item's BM25 term weight as a
share of the item's weights, so a passage's score is the share of the item that it has, from 0 to 1,
and one threshold fits all items. Postings are in item order and cut into blocks of items; for each
term and block the largest weight is kept. A passage opens only blocks for which its terms' largest
weights reach the threshold; within an open block WAND moves from pivot to pivot, so items that
cannot reach the threshold are never scored, and all others are.

Passages cover whole texts: windows of two segments, every segment being at least as long as the
longest item of the index, so that an item stands whole in one of them. Retrieved items are verified
word by word: of the question's and of the answer's five-word shingles, at least ``OVERLAP`` each must
be in the passage. The answer is an item's last sentence; of an item with one sentence, its second half.

Items are indexed in groups of similar length and at most ``GROUP_BYTES``, one pass over the documents
for each, so what is broadcast is bounded. Defined results: items without a word and missing texts
match nothing. Repeated documents with one doc_id are one; a missing doc_id is reported as such.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guildmart.llm.common import alnum_words
from guildmart.sources.warehouse import written

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
BLOCK_ITEMS = 8
SEGMENT_WORDS = 64  # of the shortest items; longer ones take four times as many, and so on
GROUP_BYTES = 16 * 1024 * 1024
_SENTENCE = re.compile(r"[.?!\n]+(?=\s|$)")


def words(text: str | None) -> list[bytes]:
    return alnum_words((text or "").lower().encode("utf-8", "replace"))


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    parts = [w for w in map(words, _SENTENCE.split(text)) if w]
    if len(parts) > 1:
        return [w for part in parts[:-1] for w in part], parts[-1]
    only = parts[0] if parts else []
    return only[: (len(only) + 1) // 2], only[(len(only) + 1) // 2 :]


def shingles(words_: list[bytes]) -> set[tuple]:
    """The runs of five words, or the whole if it is shorter."""
    if len(words_) < SHINGLE:
        return {tuple(words_)} if words_ else set()
    return set(zip(*(words_[i:] for i in range(SHINGLE))))


def overlap(part: list[bytes], passage: list[bytes]) -> float:
    """Share of the part's shingles that the passage has; 1 for an empty part."""
    wanted = shingles(part)
    if not wanted:
        return 1.0
    n = min(SHINGLE, len(part))
    there = set(zip(*(passage[i:] for i in range(n))))
    return len(wanted & there) / len(wanted)


class Index:
    """Of (item_id, text) rows. ``segment`` is half a passage's length in words."""

    def __init__(self, items: list[tuple[int, str]], segment: int) -> None:
        self.segment = segment
        own = [(i, t, words(t)) for i, t in sorted(items, key=lambda x: (x[0] is None, x[0], x[1]))]
        own = [x for x in own if x[2]]
        self.ids = [i for i, _, _ in own]
        self.parts = [question_and_answer(t) for _, t, _ in own]
        counts = [Counter(w) for _, _, w in own]
        held = Counter(w for c in counts for w in c)
        n, mean = len(own), sum(len(w) for _, _, w in own) / max(1, len(own))
        self.terms = {w: i for i, w in enumerate(sorted(held))}
        rows = []
        for item, (count, (_, _, all_words)) in enumerate(zip(counts, own)):
            size = K1 * (1 - B + B * len(all_words) / mean)
            weights = {
                w: math.log(1 + (n - held[w] + 0.5) / (held[w] + 0.5)) * f * (K1 + 1) / (f + size)
                for w, f in count.items()
            }
            whole = sum(weights.values())
            rows += [(self.terms[w], item, x / whole) for w, x in weights.items()]
        rows.sort()
        self.n_blocks = -(-n // BLOCK_ITEMS)
        self.postings: dict[tuple[int, int], list[tuple[int, float]]] = {}
        for term, item, weight in rows:
            self.postings.setdefault((term, item // BLOCK_ITEMS), []).append((item, weight))
        # The largest weight of each term and block, by term.
        self.most = {key: max(w for _, w in found) for key, found in self.postings.items()}
        keys = sorted(self.most)
        starts = np.searchsorted(np.array([t for t, _ in keys], dtype=np.int64), np.arange(len(self.terms) + 1))
        self.start, self.length = starts[:-1], np.diff(starts)
        self.block = np.array([b for _, b in keys], dtype=np.int64)
        self.bound = np.array([self.most[k] for k in keys])

    def open_blocks(self, terms: np.ndarray, segments: np.ndarray, n_segments: int) -> np.ndarray:
        """(passage, block) pairs whose terms' block maxima reach the threshold.

        A term in both segments of a passage counts twice, which only makes the bound larger.
        """
        pairs = np.unique(segments * len(self.terms) + terms)
        segments, terms = np.divmod(pairs, len(self.terms))
        length = self.length[terms]
        at = np.repeat(self.start[terms] - np.cumsum(length) + length, length) + np.arange(length.sum())
        cell = np.repeat(segments, length) * self.n_blocks + self.block[at]
        bounds = np.bincount(cell, weights=self.bound[at], minlength=n_segments * self.n_blocks)
        bounds = bounds.reshape(n_segments, self.n_blocks)
        both = bounds.copy()
        both[:-1] += bounds[1:]
        return np.argwhere(both >= THRESHOLD - 1e-9)

    def wand(self, terms: list[int], block: int) -> list[tuple[int, float]]:
        """(item, score) of the block's items that reach the threshold with these terms."""
        lists = [(self.most[t, block], self.postings[t, block]) for t in terms if (t, block) in self.postings]
        cursors, found = [0] * len(lists), []
        while True:
            # Lists in order of the item they stand at; the pivot is where their maxima reach the threshold.
            live = sorted((lists[k][1][cursors[k]][0], k) for k in range(len(lists)) if cursors[k] < len(lists[k][1]))
            bound, pivot = 0.0, None
            for item, k in live:
                bound += lists[k][0]
                if bound >= THRESHOLD - 1e-9:
                    pivot = item
                    break
            if pivot is None:
                return found
            if live[0][0] == pivot:
                here = [k for item, k in live if item == pivot]
                score = sum(lists[k][1][cursors[k]][1] for k in here)
                if score >= THRESHOLD - 1e-9:
                    found.append((pivot, score))
                for k in here:
                    cursors[k] += 1
            else:
                for item, k in live:
                    if item < pivot:
                        while cursors[k] < len(lists[k][1]) and lists[k][1][cursors[k]][0] < pivot:
                            cursors[k] += 1

    def retrieve(self, all_words: list[bytes]):
        """Yield (passage, item, score) for every passage of the text and item above the threshold."""
        found = np.array(list(map(self.terms.get, all_words, repeat(-1))), dtype=np.int64)
        at = np.flatnonzero(found >= 0)
        if not len(at):
            return
        terms, segments = found[at], at // self.segment
        n_segments = -(-len(all_words) // self.segment)
        last, own = None, []
        for passage, block in self.open_blocks(terms, segments, n_segments).tolist():
            if passage != last:
                own = np.unique(terms[(segments == passage) | (segments == passage + 1)]).tolist()
                last = passage
            for item, score in self.wand(own, block):
                yield passage, item, score

    def leaks(self, text: str | None) -> list[dict]:
        """The items whose question and answer stand in a passage of the text."""
        all_words = words(text)
        best: dict[int, list] = {}
        for passage, item, score in self.retrieve(all_words):
            start = passage * self.segment
            window = all_words[start : start + 2 * self.segment]
            question, answer = (overlap(part, window) for part in self.parts[item])
            if question >= OVERLAP and answer >= OVERLAP:
                own = best.setdefault(item, [0, 0.0, 0.0, 0.0])
                best[item] = [own[0] + 1, max(own[1], score), max(own[2], question), max(own[3], answer)]
        names = ("n_passages", "score", "question_overlap", "answer_overlap")
        return [{"item_id": self.ids[i], **dict(zip(names, own))} for i, own in sorted(best.items())]


LEAK = "item_id bigint, n_passages bigint, score double, question_overlap double, answer_overlap double"


def _leaks_udf(shared):
    fields = ", ".join(x.strip().replace(" ", ": ") for x in LEAK.split(","))

    @F.pandas_udf(f"array<struct<{fields}>>")
    def leaks(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.leaks(t) for t in texts])

    return leaks


def _indexes(items: DataFrame):
    """An index of each group of items, one after another, each of about GROUP_BYTES of text at most."""
    n_words = F.size(F.regexp_extract_all("text", F.lit("([A-Za-z0-9\\u0080-\\uffff]+)"), F.lit(1)))
    level = F.greatest(F.lit(0), F.ceil(F.log(4.0, F.greatest(F.lit(1), n_words) / F.lit(SEGMENT_WORDS)))).cast("int")
    kept = written(
        items.where("text is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text", level.alias("level"))
    )
    sizes = kept.groupBy("level").agg(F.sum(F.octet_length("text")).alias("bytes")).orderBy("level").collect()
    for size in sizes:
        groups = max(1, math.ceil(size.bytes / GROUP_BYTES))
        for group in range(groups):
            own = kept.where((F.col("level") == size.level) & (F.pmod(F.xxhash64("text"), F.lit(groups)) == group))
            rows = [(r.item_id, r.text) for r in own.collect()]
            longest = max((len(words(t)) for _, t in rows), default=0)
            yield Index(rows, max(SEGMENT_WORDS * 4**size.level, longest))


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_passages, score, question_overlap, answer_overlap), one row per pair."""
    spark, found = docs.sparkSession, []
    for index in _indexes(items):
        if not index.ids:
            continue
        leaks = _leaks_udf(spark.sparkContext.broadcast(index))
        rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), leaks("text").alias("leaks"))
        found.append(rows.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*"))
    if not found:
        return spark.createDataFrame([], f"doc_id bigint, {LEAK}")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("doc_id", "item_id").agg(
        F.max("n_passages").alias("n_passages"),
        *[F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")],
    )


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without those that hold a benchmark item. Rows without doc_id are judged by their text."""
    leaks = written(find_leaks(docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text"), items))
    gone = leaks.select(F.col("doc_id").alias("_row")).distinct()
    return docs.join(gone, F.xxhash64(docs["doc_id"], docs["text"]) == F.col("_row"), "left_anti")
