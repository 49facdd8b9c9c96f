"""Language model scoring with sharded Elias-Fano tries of word triples.

P(w | g h) = (c(g h w) + MU * P(w | h)) / (c(g h) + MU), P(w | h) = (c(h w) + MU * P(w)) / (c(h) + MU) and
P(w) = (c(w) + 1) / (N + V + 1): counts of the two words before, smoothed with those of the one before,
and these with the add-one model of single words, which is what the base score uses. All sum to one
over the V training words and one unknown word. Before a text's first word stands the start alone.

Counting and scoring are two rounds of packed messages, so that no row is made per word:

1. Documents are cut into chunks of about ``CHUNK_WORDS`` words (a longer text ends its chunk); a chunk
   keeps a dictionary of its distinct words (64-bit hashes) and its text as numbers in it. Dictionaries
   go, by hash, to word shards, which sum the counts, number the words by frequency, and answer with
   numbers and counts.
2. A chunk's distinct pairs and triples of word numbers, with their training counts, go to shards by the
   pair's first word; one with more than a quarter of a shard is spread over several by the second word,
   and the triples of two such words by the word before both. A shard sums the counts of all chunks,
   builds its trie, looks everything up, and answers with codes: a pair's smoothed probability and its
   count as a context, and a triple's count, which is smoothed with them where it is scored. Chunks sum
   their documents themselves, so even a pair that is a third of all words is one entry per chunk.

The number of shards grows with the words, so a shard's memory doesn't, and all tables cover the whole
corpus. Written chunks and word numbers bound what a lost executor costs.

Defined results: a missing or empty text is its end token alone. Held-out documents are scored and
never counted. Rows with equal doc_id are documents of their own. Without training documents every
word is unknown.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guildmart.llm.common import Frames, pack, pack_all, unpack, unpack_all, utf8
from guildmart.llm.elias_fano import Trie, quantise_counts, restore, restore_counts
from guildmart.sources.warehouse import written

MU = 50.0
CHUNK_WORDS = 1_000_000
SHARD_BYTES = 2_500_000  # of the packed texts, some 1,200,000 words
FOLDS, HELD_OUT = 7, 2
CONTEXT_SHARE = 4  # a context with over 1/4 of a shard's words is spread
# Word numbers below FIRST_WORD: the context of a first word, and all words of no training document.
START, UNKNOWN, FIRST_WORD = 0, 1, 2
_END = b"\n"  # no word has white space


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), _END]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def _chunks(docs: DataFrame) -> DataFrame:
    """(chunk, ids, missing, held, lengths, words, numbers) packed, of (row, doc_id, held_out, text)."""

    def one(rows: list[tuple], hashes: _Hashes) -> dict:
        all_hashes = np.concatenate([h for *_, h in rows])
        words, numbers, times = np.unique(all_hashes, return_inverse=True, return_counts=True)
        # The chunk's most frequent words get the smallest numbers, which pack best.
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(words), dtype=np.uint32)
        rank[order] = np.arange(len(words))
        words, numbers = words[order], rank[numbers]
        hashes.clear()
        return {
            "chunk": rows[0][0],
            "ids": pack(np.array([i for _, i, *_ in rows]), "<i8"),
            "missing": pack(np.array([m for _, _, m, *_ in rows]), "u1"),
            "held": pack(np.array([h for *_, h, _ in rows]), "u1"),
            "lengths": pack(np.array([len(h) for *_, h in rows]), "<u4"),
            "words": pack(words, "<u8"),
            "numbers": pack(numbers, "<u4"),
        }

    def cut(frames: Frames) -> Frames:
        hashes, rows, size = _Hashes(), [], 0
        for frame in frames:
            columns = (frame[c].tolist() for c in ("row", "doc_id", "missing", "held_out"))
            for *names, text in zip(*columns, frame.text):
                own = tokens(text)
                rows.append((*names, np.array(list(map(hashes.__getitem__, own)), dtype=np.uint64)))
                size += len(own)
                if size >= CHUNK_WORDS:
                    yield pd.DataFrame([one(rows, hashes)])
                    rows, size = [], 0
        if rows:
            yield pd.DataFrame([one(rows, hashes)])

    return docs.mapInPandas(
        cut, "chunk bigint, ids binary, missing binary, held binary, lengths binary, words binary, numbers binary"
    )


def _number_words(chunks: DataFrame, shards: int) -> DataFrame:
    """(chunk, shard, ids, counts, kinds, total): answers of the word shards, in order of the hashes."""

    def send(frames: Frames) -> Frames:
        for frame in frames:
            for row in frame.itertuples():
                words, numbers = unpack(row.words, "<u8"), unpack(row.numbers, "<u4")
                learnt = np.repeat(unpack(row.held, "u1") == 0, unpack(row.lengths, "<u4"))
                counts = np.bincount(numbers[learnt], minlength=len(words))
                to = (words % np.uint64(shards)).astype(np.int64)
                for shard in np.unique(to).tolist():
                    at = to == shard
                    yield pd.DataFrame(
                        {"shard": [shard], "chunk": [row.chunk], "words": [pack(words[at], "<u8")], "counts": [pack(counts[at], "<u4")]}
                    )

    def answer(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        words = [unpack(b, "<u8") for b in frame.words]
        counts = [unpack(b, "<u4") for b in frame.counts]
        known, at = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts), minlength=len(known)).astype(np.int64)
        order = np.argsort(-total, kind="stable")
        # The most frequent words of every shard get the smallest numbers, which pack best.
        ids = np.empty(len(known), dtype=np.int64)
        ids[order] = np.arange(len(known)) * shards + int(key[0]) + FIRST_WORD
        ids[total == 0] = UNKNOWN
        ends = np.cumsum([len(w) for w in words])[:-1]
        return pd.DataFrame(
            {
                "chunk": frame.chunk,
                "shard": int(key[0]),
                "ids": [pack(x, "<u8") for x in np.split(ids[at], ends)],
                "counts": [pack(x, "<u8") for x in np.split(total[at], ends)],
                "kinds": int((total > 0).sum()),
                "total": int(total.sum()),
            }
        )

    sent = chunks.select("chunk", "held", "lengths", "words", "numbers").mapInPandas(
        send, "shard int, chunk bigint, words binary, counts binary"
    )
    return sent.groupBy("shard").applyInPandas(
        answer, "chunk bigint, shard int, ids binary, counts binary, kinds bigint, total bigint"
    )


def _placed(chunks: DataFrame, shards: int) -> DataFrame:
    """The chunks with the shards of their words, which pack, in place of the words, which do not."""

    def place(frames: Frames) -> Frames:
        for frame in frames:
            yield frame.assign(words=[pack(unpack(b, "<u8") % np.uint64(shards), "<u8") for b in frame.words])

    return chunks.mapInPandas(place, chunks.schema)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _spread(counts: np.ndarray, shards: int, total: int) -> np.ndarray:
    """Over how many shards words of these counts are spread, by the share of the words that they are."""
    return np.minimum(shards, 1 + counts * (CONTEXT_SHARE * shards) // max(1, total)).astype(np.uint64)


def pair_shards(contexts: np.ndarray, counts: np.ndarray, words: np.ndarray, shards: int, total: int) -> np.ndarray:
    """Shard of each pair; a context is spread over as many shards as its share of the words asks for."""
    spread = _spread(counts, shards, total)
    return ((_mixed(contexts) + _mixed(words) % spread) % np.uint64(shards)).astype(np.int64)


def triple_shards(pair_shard: np.ndarray, counts: np.ndarray, before: np.ndarray, shards: int, total: int) -> np.ndarray:
    """Shard of each triple: its pair's, or one of several if the pair's words (``counts`` of the rarer
    one) allow it to be frequent."""
    spread = _spread(counts, shards, total)
    return ((pair_shard.astype(np.uint64) + _mixed(before) % spread) % np.uint64(shards)).astype(np.int64)


def _unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, of 0 and more, in order, and each one's place among them.

    One sort of values that carry where they stood, several times as fast as one of their places.
    """
    if not len(values):
        return values, np.empty(0, dtype=np.int64)
    bits = len(values).bit_length()
    if int(values.max()).bit_length() + bits > 63:
        return np.unique(values, return_inverse=True)
    both = np.sort((values << bits) | np.arange(len(values)))
    found = both >> bits
    new = np.append(True, found[1:] != found[:-1])
    place = np.empty(len(values), dtype=np.int64)
    place[both & ((1 << bits) - 1)] = np.cumsum(new) - 1
    return found[new], place


class _Chunk:
    """A chunk's texts as numbers in its dictionary, which is in order of the word numbers, its distinct
    pairs, and its distinct triples as a pair and the word before it."""

    def __init__(self, row, shards: int, total: int, starts: int) -> None:
        hashes, numbers = unpack(row.words, "<u8"), unpack(row.numbers, "<u4")
        ids, counts = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
        to = (hashes % np.uint64(shards)).astype(np.int64)
        for part in row.answers:
            at = to == part["shard"]
            ids[at], counts[at] = unpack(part["ids"], "<u8"), unpack(part["counts"], "<u8")
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        # The start comes last.
        self.ids, self.counts = np.append(ids[order], START), np.append(counts[order], starts)
        self.words = rank[numbers]
        self.lengths, self.held = unpack(row.lengths, "<u4").astype(np.int64), unpack(row.held, "u1")
        kinds, first = len(ids) + 1, np.cumsum(self.lengths) - self.lengths
        context = np.roll(self.words, 1)
        context[first] = len(ids)
        pairs, pair = _unique(context * kinds + self.words)
        self.pair = pair.astype(np.uint32)
        self.heads, self.tails = np.divmod(pairs, kinds)
        # A first word has no triple; all others have the context of the word before them.
        self.later = np.ones(len(self.words), dtype=bool)
        self.later[first] = False
        at = np.flatnonzero(self.later)
        triples, triple = _unique(pair[at] * kinds + context[at - 1])
        self.triple = triple.astype(np.uint32)
        self.of_pair, self.before = np.divmod(triples, kinds)
        self._place(shards, total)

    def _place(self, shards: int, total: int) -> None:
        """What goes to which shard, the same whenever the chunk is read."""
        own = pair_shards(self.ids[self.heads], self.counts[self.heads], self.ids[self.tails], shards, total)
        rarer = np.minimum(self.counts[self.heads], self.counts[self.tails])
        third = triple_shards(own[self.of_pair], rarer[self.of_pair], self.ids[self.before], shards, total)
        self.pairs_of, self.triples_of = _by_shard(own, shards), _by_shard(third, shards)
        self.shards = sorted({*self.pairs_of, *self.triples_of})

    def messages(self):
        """(shard, message): see ``_MESSAGE``. A pair that is there for its triples only counts nothing."""
        learnt = np.repeat(self.held == 0, self.lengths)
        learnt2 = np.bincount(self.pair, weights=learnt, minlength=len(self.heads))
        learnt3 = np.bincount(self.triple, weights=learnt[self.later], minlength=len(self.before))
        nothing = np.empty(0, dtype=np.int64)
        for shard in self.shards:
            listed, third = self.pairs_of.get(shard, nothing), self.triples_of.get(shard, nothing)
            parents, own = self.of_pair[third], np.ones(len(listed), dtype=bool)
            at = np.searchsorted(listed, parents)
            guests = np.append(listed, -1)[at] != parents
            if guests.any():
                every = np.union1d(listed, parents)
                own = np.zeros(len(every), dtype=bool)
                own[np.searchsorted(every, listed)] = True
                listed = every
            new = np.append(True, self.heads[listed][1:] != self.heads[listed][:-1])[: len(listed)]
            first = np.flatnonzero(new)
            heads = self.heads[listed[first]]
            tails, number = _unique(self.tails[listed])
            before, third_number = _unique(self.before[third])
            ends = np.searchsorted(parents, listed)
            message = [
                np.diff(self.ids[heads], prepend=0),
                self.counts[heads],
                np.diff(np.append(first, len(listed))),
                np.diff(self.ids[tails], prepend=0),
                self.counts[tails],
                number,
                np.where(own, learnt2[listed], 0),
                own,
                np.diff(self.ids[before], prepend=0),
                np.diff(np.append(ends, len(third))),
                third_number,
                learnt3[third],
            ]
            yield shard, message


def _by_shard(shard: np.ndarray, shards: int) -> dict[int, np.ndarray]:
    """The places of each shard that has any, in order."""
    order = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[order], np.arange(shards + 1))
    return {k: order[ends[k] : ends[k + 1]] for k in np.flatnonzero(np.diff(ends)).tolist()}


def _send_pairs(numbered: DataFrame, shards: int, total: int, starts: int) -> DataFrame:
    """Messages to the shards: each chunk's distinct pairs and triples with their training counts."""

    def send(frames: Frames) -> Frames:
        for frame in frames:
            for row in frame.itertuples():
                for shard, message in _Chunk(row, shards, total, starts).messages():
                    yield pd.DataFrame({"shard": [shard], "chunk": [row.chunk], "message": [pack_all(message, _MESSAGE)]})

    return numbered.mapInPandas(send, "shard int, chunk bigint, message binary")


# Of a message: the distinct first words (differences of their numbers, in order) with their counts and
# numbers of pairs; the distinct second words alike; each pair's second word, training count, and whether
# it is answered here; the distinct words before pairs; each pair's number of triples; each triple's word
# before and training count.
_MESSAGE = ["<i8", "<u8", "<u4", "<i8", "<u8", "<u4", "<u4", "u1", "<i8", "<u4", "<u4", "<u4"]
_ANSWER = ["<u2", "<u2", "<u2"]


def smoothed(pair: np.ndarray, context: np.ndarray, word: np.ndarray, unit: int) -> np.ndarray:
    """log10 P(w | h) from c(h w), c(h) and c(w)."""
    return np.log10((pair + MU * (word + 1) / unit) / (context + MU))


class _Messages:
    """The entries of a shard's messages, one after another: pairs as places of words in the messages' own
    lists of them, triples as places of pairs and words."""

    def __init__(self, blobs) -> None:
        parts = [unpack_all(b, _MESSAGE) for b in blobs]

        def joined(column: int, dtype=np.int64) -> np.ndarray:
            return np.concatenate([p[column] for p in parts]).astype(dtype)

        def numbers(column: int) -> np.ndarray:
            return np.concatenate([np.cumsum(p[column]) for p in parts])

        def shifted(column: int, by: list[int]) -> np.ndarray:
            ends = np.cumsum([0, *by[:-1]])
            return np.concatenate([p[column].astype(np.int64) + end for p, end in zip(parts, ends)])

        self.heads, self.tails, self.third = numbers(0), numbers(3), numbers(8)
        self.head_counts, self.tail_counts = joined(1), joined(4)
        self.head = np.repeat(np.arange(len(self.heads)), joined(2))
        self.tail = shifted(5, [len(p[3]) for p in parts])
        self.learnt, self.own = joined(6), joined(7, bool)
        self.pair = np.repeat(np.arange(len(self.tail)), joined(9))
        self.before = shifted(10, [len(p[8]) for p in parts])
        self.before_learnt = joined(11)
        # Where each message's own pairs and triples end.
        self.pair_ends = np.cumsum([int(p[7].sum()) for p in parts])
        self.triple_ends = np.cumsum([len(p[10]) for p in parts])


def _distinct(first: np.ndarray, second: np.ndarray, times: np.ndarray):
    """Where one of each of the distinct rows of two columns is, in order; the place of each row among them; and the sums
    of ``times``."""
    first_place = _unique(first)[1]
    seconds, second_place = _unique(second)
    found, place = _unique(first_place * max(1, len(seconds)) + second_place)
    rows = np.empty(len(found), dtype=np.int64)
    rows[place] = np.arange(len(place))
    return rows, place, np.bincount(place, weights=times, minlength=len(found)).astype(np.int64)


def _trie(m: _Messages, unit: int) -> tuple[Trie, np.ndarray]:
    """The trie of a shard and the counts of its pairs. Pairs that count nothing here hold triples only."""
    learnt = np.flatnonzero(m.before_learnt)
    used = m.learnt > 0
    used[m.pair[learnt]] = True
    at = np.flatnonzero(used)
    contexts, words = m.heads[m.head[at]], m.tails[m.tail[at]]
    rows, place, counts = _distinct(contexts, words, m.learnt[at])
    contexts, words, of = contexts[rows], words[rows], at[rows]
    logs = smoothed(counts, m.head_counts[m.head[of]], m.tail_counts[m.tail[of]], unit)
    places = np.full(len(used), -1, dtype=np.int64)
    places[at] = place
    parents, before = places[m.pair[learnt]], m.third[m.before[learnt]]
    rows, _, times = _distinct(parents, before, m.before_learnt[learnt])
    return Trie(contexts, words, logs, parents[rows], before[rows], times), counts


def _look_up(unit: int):
    def look_up(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        m = _Messages(frame.message)
        trie, counts = _trie(m, unit)
        places = trie.place(m.heads, m.tails, m.head, m.tail)
        thirds = trie.counts(places[m.pair], m.third, m.before)
        places = places[m.own]
        heights = np.where(counts > 0, quantise_counts(np.maximum(counts, 1)), 0).astype("<u2")
        height = np.where(places >= 0, np.append(heights, 0)[places], 0)
        pairs = zip(np.split(trie.probabilities(places), m.pair_ends[:-1]), np.split(height, m.pair_ends[:-1]))
        answers = [pack_all([*p, t], _ANSWER) for p, t in zip(pairs, np.split(thirds, m.triple_ends[:-1]))]
        return pd.DataFrame({"chunk": frame.chunk, "shard": int(key[0]), "codes": answers})

    return look_up


def _sum_documents(found: DataFrame, shards: int, total: int, kinds: int, starts: int) -> DataFrame:
    """Scores of each chunk's documents from the codes of its pairs and triples."""
    unit = total + kinds + 1

    def sums(frames: Frames) -> Frames:
        for frame in frames:
            for row in frame.itertuples():
                one = _Chunk(row, shards, total, starts)
                codes, heights = (np.zeros(len(one.heads), dtype="<u2") for _ in range(2))
                thirds = np.zeros(len(one.before), dtype="<u2")
                nothing = np.empty(0, dtype=np.int64)
                for part in row.codes:
                    own, third = (x.get(part["shard"], nothing) for x in (one.pairs_of, one.triples_of))
                    codes[own], heights[own], thirds[third] = unpack_all(part["codes"], _ANSWER)
                backoff = smoothed(np.zeros(len(codes)), one.counts[one.heads], one.counts[one.tails], unit)
                logs = np.where(codes > 0, restore(codes), backoff)[one.pair]
                contexts = restore_counts(heights)[one.pair]
                at = np.flatnonzero(one.later)
                times = restore_counts(thirds)[one.triple]
                logs[at] = np.log10((times + MU * 10 ** logs[at]) / (contexts[at - 1] + MU))
                doc, count = np.repeat(np.arange(len(one.lengths)), one.lengths), one.counts[one.words]
                add = lambda values: np.bincount(doc, weights=values, minlength=len(one.lengths))
                yield pd.DataFrame(
                    {
                        "doc_id": pd.Series(unpack(row.ids, "<i8"), dtype="Int64").mask(unpack(row.missing, "u1") > 0),
                        "held_out": one.held > 0,
                        "n_tokens": one.lengths,
                        "n_known": add(count > 0).astype(np.int64),
                        "base_score": add(np.log10((count + 1) / unit)),
                        "score": add(logs),
                    }
                )

    return found.mapInPandas(sums, _SCORED)


_SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def score(docs: DataFrame, held_out) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``held_out`` is a condition on the columns of ``docs``: those documents are not learnt from.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNull().alias("missing"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        utf8().alias("text"),
    )
    # A chunk is named by its first row, once and for all as it is written.
    chunks = written(_chunks(rows))
    starts = docs.where(~F.coalesce(held_out, F.lit(False))).count()
    packed = chunks.agg(F.coalesce(F.sum(F.octet_length("numbers")), F.lit(0)).alias("bytes")).first().bytes
    shards = max(4, math.ceil(packed / SHARD_BYTES))
    answers = written(_number_words(chunks, shards))
    figures = answers.select("shard", "kinds", "total").distinct().agg(F.sum("kinds").alias("kinds"), F.sum("total").alias("total")).first()
    kinds, total = int(figures.kinds or 0), int(figures.total or 0)
    by_chunk = answers.groupBy("chunk").agg(F.collect_list(F.struct("shard", "ids", "counts")).alias("answers"))
    numbered = _placed(chunks, shards).join(by_chunk.hint("merge"), "chunk")
    messages = _send_pairs(numbered, shards, total, starts)
    looked_up = messages.groupBy("shard").applyInPandas(_look_up(total + kinds + 1), "chunk bigint, shard int, codes binary")
    codes = looked_up.groupBy("chunk").agg(F.collect_list(F.struct("shard", "codes")).alias("codes"))
    found = numbered.join(codes.hint("merge"), "chunk")
    return _sum_documents(found, shards, total, kinds, starts).withColumn("train_tokens", F.lit(total).cast("bigint"))
