"""Cross-tokenizer alignment: where two tokenizers cut a text alike, and which of their tokens meet.

Each text, with a space before it, is encoded by a byte-level BPE vocabulary (A) and a sentence-piece
one (B). Byte offsets where tokens of both end cut the text into groups; every A token of a group is
linked to every B token of it. A pair of ids counts the documents that hold it linked.

Groups are found by lockstep merging. A batch's token ends lie in two flat arrays, and one state vector
holds for every lane where it stands in both; a step moves all lanes at once, each on the side whose
token ends first, emits the cuts and the links of the groups closed by it, and drops finished lanes.
A lane is a document, or a stretch of a long one between two common ends, so that a batch takes about
``LANE_TOKENS`` steps whatever its longest text. A group of more than ``GROUP_LINKS`` links is emitted
by its distinct ids with the number of links of each pair, which is the same and stays small.

Documents are handled in chunks of about ``CHUNK_TOKENS`` tokens (a longer text is a chunk of its own),
written once with their distinct pairs. Spark sums a pair's documents over all chunks, combining before
the shuffle, and joins the sums back to the chunks' pairs; pairs that many chunks hold are broadcast,
at most ``HOT_SHARE`` of them. The highest count of an A id is one row per id of the vocabulary.

Defined results: missing and empty texts have no tokens, and so have texts whose tokens of either side
do not join to the text's bytes (such as one that holds U+2581). Rows are scored each, also equal ones
and those with one or no doc_id, and each counts as a document. An empty table has no rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256
from itertools import chain

import numpy as np
import pandas as pd
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guildmart.llm.common import Frames, join_keyed, pack, unpack
from guildmart.sources.warehouse import written

FOLDER = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_TOKENS = 500_000
BATCH_BYTES = 500_000
LANE_TOKENS = 512
GROUP_LINKS = 1024

# Fixed value: how the byte-level vocabulary splits a text into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable
    in Latin-1, the others in order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


@dataclass(frozen=True)
class Vocabularies:
    """The contents of two vocabulary files, of a few MB."""

    byte_bpe: bytes
    piece_bpe: bytes

    @classmethod
    def read(cls, folder: str = FOLDER, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> Vocabularies:
        found = []
        for name in (byte_bpe, piece_bpe):
            with open(f"{folder}/{name}", "rb") as file:
                found.append(file.read())
        return cls(*found)


class Encoders:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, vocabularies: Vocabularies) -> None:
        self.spec = json.loads(vocabularies.byte_bpe)
        self.json = vocabularies.byte_bpe
        alphabet, vocabulary = byte_alphabet(), self.spec["model"]["vocab"]
        special = {t["id"]: t["content"].encode() for t in self.spec["added_tokens"]}
        of_a = {i: bytes(map(alphabet.__getitem__, t)) for t, i in vocabulary.items() if i not in special} | special
        self.a_bytes = [of_a.get(i, b"") for i in range(max(of_a) + 1)]
        self.ranks = {b: i for i, b in of_a.items() if i not in special}
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.piece_bpe)
        self.b_bytes = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.a_bytes, self.b_bytes))

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    @property
    def ranked(self) -> bool:
        """Whether ids are in order of the merges and the split is the usual one, so that ranks say all."""
        model, split = self.spec["model"], self.spec["pre_tokenizer"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        first = 256
        return (
            split == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
            and self.spec["normalizer"] is None
            and not model.get("ignore_merges")
            and all(model["vocab"]["".join(m)] == first + i for i, m in enumerate(merges))
        )

    @cached_property
    def encode_a(self):
        """Ids of one text. Ranks give the same ids as the merges, five times as fast."""
        if self.ranked:
            return tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary
        merging = tokenizers.Tokenizer.from_buffer(self.json)
        merging.encode_special_tokens = True
        return lambda text: merging.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides of each text, none where either does not give the text's bytes again."""
        own_a, own_b = [], []
        for text, b in zip(texts, self.pieces.encode(texts, num_threads=1) if texts else []):
            whole = " " + text
            a = self.encode_a(whole) if text else []
            raw = whole.encode()
            same = a and b"".join(map(self.a_bytes.__getitem__, a)) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw
            own_a.append(a if same else [])
            own_b.append(b if same else [])
        return own_a, own_b


def _lanes(a_end: np.ndarray, b_end: np.ndarray, a_of: np.ndarray, b_of: np.ndarray, longest: int) -> np.ndarray:
    """(first A, first B, beyond A, beyond B) of each lane, from the first token of each document on.

    Long documents are cut at the first common end after every ``longest`` A tokens.
    """
    cuts = []
    for i in np.flatnonzero(np.diff(a_of) > longest).tolist():
        low, high = a_of[i], a_of[i + 1]
        own_b = b_end[b_of[i] : b_of[i + 1]]
        at = low + longest - 1
        while at < high - 1:
            for start in range(at, high, longest):  # the next common end may be far
                run = a_end[start : min(start + longest, high)]
                place = np.minimum(np.searchsorted(own_b, run), len(own_b) - 1)
                hits = np.flatnonzero(own_b[place] == run)
                if len(hits):
                    break
            end = start + int(hits[0])
            if end < high - 1:
                cuts.append((end + 1, b_of[i] + int(place[hits[0]]) + 1))
            at = end + longest
    firsts = np.concatenate([np.stack([a_of[:-1], b_of[:-1]], 1)[np.diff(a_of) > 0], np.array(cuts, dtype=np.int64).reshape(-1, 2)])
    firsts = firsts[np.argsort(firsts[:, 0], kind="stable")]
    beyond = np.concatenate([firsts[1:], [[len(a_end), len(b_end)]]])[: len(firsts)]
    return np.concatenate([firsts, beyond], axis=1)


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_of: np.ndarray, b_of: np.ndarray, longest: int = LANE_TOKENS):
    """(groups, links) of a batch of documents.

    ``a_end`` and ``b_end`` are the byte ends of all tokens, growing through the whole batch; ``a_of`` and
    ``b_of`` where each document's tokens begin, and the number of all. Groups are rows (first A, first B,
    last A, last B), links rows (A, B); the links of a group of more than GROUP_LINKS are left out.
    """
    lanes = _lanes(a_end, b_end, a_of, b_of, longest)
    # The state: where each lane stands in A and B, where its open group began, where it ends.
    at_a, at_b, begun_a, begun_b, stop = lanes[:, 0], lanes[:, 1], lanes[:, 0], lanes[:, 1], lanes[:, 2]
    groups, links = [], []
    while len(at_a):
        end_a, end_b = a_end[at_a], b_end[at_b]
        cut = np.flatnonzero(end_a == end_b)
        if len(cut):
            first_a, first_b, last_a, last_b = begun_a[cut], begun_b[cut], at_a[cut], at_b[cut]
            groups.append(np.stack([first_a, first_b, last_a, last_b], 1))
            wide = last_b - first_b + 1
            n = (last_a - first_a + 1) * wide
            n[n > GROUP_LINKS] = 0
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            wide = np.repeat(wide, n)
            links.append(np.stack([np.repeat(first_a, n) + within // wide, np.repeat(first_b, n) + within % wide], 1))
        at_a, at_b = at_a + (end_a <= end_b), at_b + (end_b <= end_a)
        begun_a, begun_b = begun_a.copy(), begun_b.copy()
        begun_a[cut], begun_b[cut] = at_a[cut], at_b[cut]
        if len(cut) and (finished := at_a == stop).any():
            at_a, at_b, begun_a, begun_b, stop = (x[~finished] for x in (at_a, at_b, begun_a, begun_b, stop))
    none = np.empty((0, 4), dtype=np.int64)
    groups = np.concatenate([none, *groups])
    return groups[np.argsort(groups[:, 0], kind="stable")], np.concatenate([none[:, :2], *links])


class Aligner:
    """Batches of texts aligned by both tokenizers."""

    def __init__(self, encoders: Encoders) -> None:
        self.encoders, self.width = encoders, len(encoders.b_bytes)
        numbers = [str(i) for i in range(max(len(encoders.a_bytes), self.width))]
        # A token's number with what follows it: another of its side and group, the other side, another group.
        self.shown = [n + mark for mark in ",|;" for n in numbers]
        self.count = len(numbers)

    def align(self, texts: list[str | None]) -> dict[str, np.ndarray | list[str]]:
        """Of each text: n_a, n_b, n_groups, n_links and groups_sha256. Of all together the distinct
        (document, pair) as ``doc``, ``pair`` (A id times the size of B's vocabulary, plus B id) and ``times``,
        and the groups as ``in_doc``, ``end`` (in bytes, of text with its space), ``wide_a`` and ``wide_b``."""
        own_a, own_b = self.encoders.encode([t or "" for t in texts])
        n_a, n_b = (np.array(list(map(len, x)), dtype=np.int64) for x in (own_a, own_b))
        a_of, b_of = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
        a, b = (np.fromiter(chain.from_iterable(x), dtype=np.int64, count=int(n.sum())) for x, n in ((own_a, n_a), (own_b, n_b)))
        # Both sides of a document have the same bytes, so that the ends of all follow one another alike.
        a_end, b_end = np.cumsum(self.encoders.a_sizes[a]), np.cumsum(self.encoders.b_sizes[b])
        groups, links = lockstep(a_end, b_end, a_of, b_of)
        doc_of_a = np.repeat(np.arange(len(texts)), n_a)
        doc, pair = doc_of_a[links[:, 0]], a[links[:, 0]] * self.width + b[links[:, 1]]
        times = np.ones(len(links), dtype=np.int64)
        sizes = (groups[:, 2] - groups[:, 0] + 1) * (groups[:, 3] - groups[:, 1] + 1)
        large = [self._distinct(a, b, doc_of_a, g) for g in groups[sizes > GROUP_LINKS]]
        doc, pair, times = (np.concatenate(x) for x in zip((doc, pair, times), *large))
        order = np.lexsort((pair, doc))
        doc, pair, times = doc[order], pair[order], times[order]
        first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1]))[: len(doc)])
        in_doc = doc_of_a[groups[:, 0]]
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.bincount(in_doc, minlength=len(texts)),
            "n_links": np.bincount(in_doc, weights=sizes, minlength=len(texts)).astype(np.int64),
            "groups_sha256": self._shown(a, b, groups, in_doc, len(texts)),
            "in_doc": in_doc,
            "end": a_end[groups[:, 2]] - np.concatenate([[0], a_end])[a_of[in_doc]],
            "wide_a": groups[:, 2] - groups[:, 0] + 1,
            "wide_b": groups[:, 3] - groups[:, 1] + 1,
            "doc": doc[first],
            "pair": pair[first],
            "times": np.add.reduceat(times, first) if len(first) else times,
        }

    def _distinct(self, a: np.ndarray, b: np.ndarray, doc_of_a: np.ndarray, group: np.ndarray):
        ids_a, times_a = np.unique(a[group[0] : group[2] + 1], return_counts=True)
        ids_b, times_b = np.unique(b[group[1] : group[3] + 1], return_counts=True)
        pair = (ids_a[:, None] * self.width + ids_b).ravel()
        return np.full(len(pair), doc_of_a[group[0]]), pair, (times_a[:, None] * times_b).ravel()

    def _shown(self, a: np.ndarray, b: np.ndarray, groups: np.ndarray, in_doc: np.ndarray, n: int) -> list[str]:
        """Digests of the groups as text. Tokens of both sides are put in order of their groups, A first."""
        mark_a, mark_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        mark_a[groups[:, 2]], mark_b[groups[:, 3]] = 1, 2
        wide_a, wide_b = groups[:, 2] - groups[:, 0] + 1, groups[:, 3] - groups[:, 1] + 1
        number = np.arange(len(groups))
        place_a = np.arange(len(a)) + groups[np.repeat(number, wide_a), 1]
        place_b = np.arange(len(b)) + groups[np.repeat(number, wide_b), 2] + 1
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        codes[place_a], codes[place_b] = a + mark_a * self.count, b + mark_b * self.count
        shown = list(map(self.shown.__getitem__, codes.tolist()))
        ends = np.zeros(n + 1, dtype=np.int64)
        np.add.at(ends, in_doc + 1, wide_a + wide_b)
        ends = np.cumsum(ends).tolist()
        return [
            sha256("".join(shown[low:high])[:-1].encode()).hexdigest() if high > low else ""
            for low, high in zip(ends, ends[1:])
        ]


def _batches(frames: Frames, most: int = BATCH_BYTES):
    """(rows, doc_ids, texts) of about ``most`` characters; a longer text ends its batch."""
    rows, ids, texts, size = [], [], [], 0
    for frame in frames:
        for row, doc_id, text in zip(frame.row.tolist(), frame.doc_id.tolist(), frame.text):
            rows.append(row)
            ids.append(doc_id)
            texts.append(text)
            size += len(text or "") + 1
            if size >= most:
                yield rows, ids, texts
                rows, ids, texts, size = [], [], [], 0
    if rows:
        yield rows, ids, texts


_COUNTED = ("n_a", "n_b", "n_groups", "n_links")
_CHUNK = (
    "chunk bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
    "n_links array<bigint>, groups_sha256 array<string>, pairs binary, lengths binary, numbers binary, times binary"
)


def _chunk(first: int, parts: list[tuple[list, dict]]) -> pd.DataFrame:
    """One chunk of aligned batches: its documents' figures, its distinct pairs in order, and of each
    document the numbers of its pairs and how often it holds them."""
    pairs, numbers = np.unique(np.concatenate([p["pair"] for _, p in parts]), return_inverse=True)
    lengths = [np.bincount(p["doc"], minlength=len(ids)) for ids, p in parts]
    joined = {name: [np.concatenate([p[name] for _, p in parts])] for name in _COUNTED}
    return pd.DataFrame(
        {
            "chunk": [first],
            "doc_id": [[i for ids, _ in parts for i in ids]],
            **joined,
            "groups_sha256": [[x for _, p in parts for x in p["groups_sha256"]]],
            "pairs": [pack(pairs, "<i8")],
            "lengths": [pack(np.concatenate(lengths), "<u4")],
            "numbers": [pack(numbers, "<u4")],
            "times": [pack(np.concatenate([p["times"] for _, p in parts]), "<u8")],
        }
    )


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), "text")


def _whole(value: str | None) -> int | None:
    return None if value is None else int(value)


class Alignment:
    """The aligned documents of one table, in written chunks."""

    def __init__(self, docs: DataFrame, folder: str = FOLDER, chunk_tokens: int = CHUNK_TOKENS, batch_bytes: int = BATCH_BYTES) -> None:
        self.spark: SparkSession = docs.sparkSession
        # Two vocabulary files, whose size does not follow the data.
        shared = self.spark.sparkContext.broadcast(Vocabularies.read(folder))

        def align(frames: Frames) -> Frames:
            aligner, parts, first, size = Aligner(Encoders(shared.value)), [], 0, 0
            for rows, ids, texts in _batches(frames, batch_bytes):
                first = first if parts else rows[0]
                part = aligner.align(texts)
                parts.append((list(map(_whole, ids)), part))
                size += int(part["n_a"].sum()) + len(ids)
                if size >= chunk_tokens:
                    yield _chunk(first, parts)
                    parts, size = [], 0
            if parts:
                yield _chunk(first, parts)

        self.shared = shared
        self.chunks = written(_rows(docs).mapInPandas(align, _CHUNK))
        self.width = sentencepiece.SentencePieceProcessor(model_proto=shared.value.piece_bpe).get_piece_size()

    def held(self) -> DataFrame:
        """(chunk, pair, n): the documents of a chunk that hold a pair linked."""

        def spread(frames: Frames) -> Frames:
            for frame in frames:
                for chunk, pairs, numbers in zip(frame.chunk, frame.pairs, frame.numbers):
                    pairs = unpack(pairs, "<i8")
                    n = np.bincount(unpack(numbers, "<u4"), minlength=len(pairs))
                    yield pd.DataFrame({"chunk": chunk, "pair": pairs, "n": n})

        return self.chunks.select("chunk", "pairs", "numbers").mapInPandas(spread, "chunk bigint, pair bigint, n bigint")

    @cached_property
    def sums(self) -> DataFrame:
        """(pair, n, chunks): the documents and chunks of each pair, written."""
        return written(self.held().groupBy("pair").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("chunks")))

    def pairs(self) -> DataFrame:
        """(pair, a, b, n, best, chunks): ``best`` if no pair of the A id is held by more documents."""
        a = F.floor(F.col("pair") / F.lit(self.width)).cast("int").alias("a")
        named = self.sums.select("pair", a, F.pmod("pair", F.lit(self.width)).cast("int").alias("b"), "n", "chunks")
        # One row per id of vocabulary A.
        highest = named.groupBy("a").agg(F.max("n").alias("_highest"))
        found = named.join(F.broadcast(highest), "a")
        return found.select("pair", "a", "b", "n", (F.col("n") == F.col("_highest")).alias("best"), "chunks")

    def documents(self) -> DataFrame:
        """A row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
        total = self.sums.agg(F.coalesce(F.sum("chunks"), F.lit(0)).alias("total")).first().total
        code = (F.col("n") * 2 + F.col("best").cast("int")).alias("code")
        counted = self.pairs().select("pair", code, "chunks")
        met = join_keyed(self.held().select("chunk", "pair"), counted, ["pair"], "inner", total, "chunks")
        # A chunk's pairs are in order, so that the codes alone say which is whose.
        in_order = F.sort_array(F.collect_list(F.struct("pair", "code")))
        answers = met.groupBy("chunk").agg(F.transform(in_order, lambda x: x["code"]).alias("codes"))

        def finish(frames: Frames) -> Frames:
            for frame in frames:
                for row in frame.itertuples():
                    numbers, times = unpack(row.numbers, "<u4"), unpack(row.times, "<u8").astype(np.int64)
                    lengths = unpack(row.lengths, "<u4").astype(np.int64)
                    codes = np.array([] if row.codes is None else row.codes, dtype=np.int64)[numbers]
                    ends = np.concatenate([[0], np.cumsum(lengths)])
                    best, sums = (np.concatenate([[0], np.cumsum(times * x)]) for x in (codes & 1, codes >> 1))
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array(list(row.doc_id), dtype="Int64"),
                            **{name: getattr(row, name) for name in _COUNTED},
                            "n_best": best[ends[1:]] - best[ends[:-1]],
                            "count_sum": sums[ends[1:]] - sums[ends[:-1]],
                            "groups_sha256": row.groups_sha256,
                        }
                    )

        return self.chunks.join(answers, "chunk", "left").mapInPandas(
            finish,
            "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
            "count_sum bigint, groups_sha256 string",
        )


def groups(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """A row per document: doc_id and ``groups``, each with its end (in bytes of the text with a space
    before it) and its numbers of A and B tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabularies.read(folder))

    def cut(frames: Frames) -> Frames:
        aligner = Aligner(Encoders(shared.value))
        for _, ids, texts in _batches(frames):
            found = aligner.align(texts)
            ends = np.searchsorted(found["in_doc"], np.arange(len(ids) + 1))
            columns = {name: [found[name][low:high] for low, high in zip(ends, ends[1:])] for name in ("end", "wide_a", "wide_b")}
            yield pd.DataFrame({"doc_id": pd.array(list(map(_whole, ids)), dtype="Int64"), **columns})

    cuts = _rows(docs).mapInPandas(cut, "doc_id bigint, end array<bigint>, wide_a array<bigint>, wide_b array<bigint>")
    return cuts.select("doc_id", F.arrays_zip("end", "wide_a", "wide_b").alias("groups"))
