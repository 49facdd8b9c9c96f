"""Elias-Fano sequences and a memory-mapped trie of word triples.

A non-decreasing sequence is kept as the low bits of its values, packed, and their high bits in unary:
about two bits and the low bits per value. It is searched as it stands: the only thing beside it is a
count of the unary part's zeros before every 64 bits.

The trie has plain bytes in one unlinked temporary file that is mapped, not read. Its levels are
contexts, their successors, and what stood before both; between levels stand pointers to the range of
each node's children. A child is numbered within the trie's vocabulary and shifted by its parent's
rank, which makes a whole level one monotone sequence; searching a child relative to its parent is one
successor search in that sequence. Successors carry quantised probabilities, the last level counts.
"""

from __future__ import annotations

import tempfile

import numpy as np

# log10 probabilities from -LOWEST to 0, and counts' log10 from 0 to HIGHEST, in steps; 0 stands for none.
LOWEST, HIGHEST, STEPS = 12.0, 16.0, 65_534


def quantise(logs: np.ndarray) -> np.ndarray:
    return (1 + np.rint(np.clip(-logs, 0, LOWEST) * (STEPS / LOWEST))).astype("<u2")


def restore(codes: np.ndarray) -> np.ndarray:
    return -(codes.astype(np.float64) - 1) * (LOWEST / STEPS)


def quantise_counts(counts: np.ndarray) -> np.ndarray:
    """Codes of numbers of one or more, by their logarithms."""
    return (1 + np.rint(np.clip(np.log10(counts), 0, HIGHEST) * (STEPS / HIGHEST))).astype("<u2")


def restore_counts(codes: np.ndarray) -> np.ndarray:
    """The numbers, 0 where there is none."""
    return np.where(codes > 0, 10 ** ((codes.astype(np.float64) - 1) * (HIGHEST / STEPS)), 0.0)


def _nth_set() -> np.ndarray:
    """The place of the n-th one of every byte."""
    table = np.zeros((256, 8), dtype=np.uint8)
    for byte in range(256):
        ones = [bit for bit in range(8) if byte >> bit & 1]
        table[byte, : len(ones)] = ones
    return table


_NTH_SET = _nth_set()
_PAIRS, _FOURS, _NIBBLES, _BYTES, _TOPS = (np.uint64(0x0101010101010101 * x) for x in (0x55, 0x33, 0x0F, 0x01, 0x80))


def _select(words: np.ndarray, before: np.ndarray, n: np.ndarray, zeros: bool = False) -> np.ndarray:
    """The places of the n-th ones (or zeros) in words of 64 bits; ``before`` counts those before each word."""
    at = np.searchsorted(before, n, side="right") - 1
    left = (n - before[at]).astype(np.uint64)
    bits = ~words[at] if zeros else words[at]
    # the ones of every byte, then those of it and the lower ones, each in its byte
    ones = bits - ((bits >> np.uint64(1)) & _PAIRS)
    ones = (ones & _FOURS) + ((ones >> np.uint64(2)) & _FOURS)
    ones = ((ones + (ones >> np.uint64(4))) & _NIBBLES) * _BYTES
    byte = np.bitwise_count(((left * _BYTES | _TOPS) - ones) & _TOPS).astype(np.uint64) << np.uint64(3)
    left -= ((ones << np.uint64(8)) >> byte) & np.uint64(255)
    return at * 64 + byte.astype(np.int64) + _NTH_SET[(bits >> byte) & np.uint64(255), left]


class EliasFano:
    """A non-decreasing sequence of integers from 0 on, over (low bytes, high words)."""

    def __init__(self, low: np.ndarray, high: np.ndarray, n: int, bits: int) -> None:
        self.low, self.n, self.bits = low, n, bits
        self.high = high.view("<u8")
        ones = np.bitwise_count(self.high).astype(np.int64)
        self.ones = np.cumsum(ones) - ones
        self.zeros = np.arange(len(ones)) * 64 - self.ones
        self.buckets = int(64 * len(ones) - ones.sum())

    @staticmethod
    def parts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, int]:
        """Bytes of the low and of the high bits, the length and the number of low bits."""
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        if bits:
            octets = np.ascontiguousarray(values, dtype="<i8").view(np.uint8).reshape(-1, 8)
            matrix = np.unpackbits(octets, axis=1, count=bits, bitorder="little")
            low = np.packbits(matrix.ravel(), bitorder="little")
        else:
            low = np.empty(0, dtype=np.uint8)
        unary = np.zeros(-(-(n + (top >> bits) + 2) // 64) * 64, dtype=np.uint8)
        unary[(values >> bits) + np.arange(n)] = 1
        padding = np.zeros(8 + -len(low) % 8, np.uint8)
        return np.concatenate([low, padding]), np.packbits(unary, bitorder="little"), n, bits

    def _low(self, at: np.ndarray) -> np.ndarray:
        """The low bits of the values at these places, from a window of eight bytes each."""
        if not self.bits:
            return np.zeros(len(at), dtype=np.int64)
        first = at * self.bits
        window = np.zeros(len(at), dtype=np.uint64)
        for k in range(min(8, (self.bits + 14) // 8)):
            window |= self.low[(first >> 3) + k].astype(np.uint64) << np.uint64(8 * k)
        return ((window >> (first & 7).astype(np.uint64)) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def _start(self, high: np.ndarray) -> np.ndarray:
        """The number of values whose high bits are below the given ones."""
        start = np.zeros(len(high), dtype=np.int64)
        inside = np.flatnonzero((high > 0) & (high <= self.buckets))
        start[inside] = _select(self.high, self.zeros, high[inside] - 1, zeros=True) - high[inside] + 1
        start[high > self.buckets] = self.n
        return np.minimum(start, self.n)

    def search(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the first element not below each value (n if there is none), and whether it is equal."""
        high, low = values >> self.bits, values & ((1 << self.bits) - 1)
        begin, end = self._start(high), self._start(high + 1)
        bound = end.copy()
        while len(open_ := np.flatnonzero(begin < end)):
            middle = (begin[open_] + end[open_]) // 2
            less = self._low(middle) < low[open_]
            begin[open_] = np.where(less, middle + 1, begin[open_])
            end[open_] = np.where(less, end[open_], middle)
        equal = begin < bound
        equal[equal] = self._low(begin[equal]) == low[equal]
        return begin, equal

    def find(self, values: np.ndarray) -> np.ndarray:
        return self.search(values)[0]

    def at(self, places: np.ndarray) -> np.ndarray:
        """The values at these places."""
        return ((_select(self.high, self.ones, places) - places) << self.bits) | self._low(places)

    def values(self) -> np.ndarray:
        return self.at(np.arange(self.n))


class Trie:
    """Successors of contexts with quantised log10 probabilities, and counts of what stood before both."""

    def __init__(
        self,
        contexts: np.ndarray,
        successors: np.ndarray,
        logs: np.ndarray,
        parents: np.ndarray,
        third: np.ndarray,
        counts: np.ndarray,
    ) -> None:
        """Of distinct pairs in order of (context, successor); and of distinct (parent, third) in order, where
        a parent is a pair's place."""
        heads, first = np.unique(contexts, return_index=True)
        words, number = np.unique(successors, return_inverse=True)
        before, third_number = np.unique(third, return_inverse=True)
        self.universe, self.third_universe, n = max(1, len(words)), max(1, len(before)), len(contexts)
        rank = np.repeat(np.arange(len(heads)), np.diff(np.append(first, n)))
        levels = [
            heads,
            np.append(first, n),
            words,
            rank * self.universe + number,
            before,
            np.searchsorted(parents, np.arange(n + 1)),
            parents * self.third_universe + third_number,
        ]
        sizes, self.file = [], tempfile.TemporaryFile()
        for values in levels:
            low, high, length, bits = EliasFano.parts(values.astype(np.int64))
            self.file.write(low.tobytes())
            self.file.write(high.tobytes())
            sizes.append((len(low), len(high), length, bits))
        for codes in (quantise(logs), quantise_counts(counts)):
            self.file.write(codes.tobytes())
        self.file.flush()
        mapped = np.memmap(self.file, dtype=np.uint8, mode="r")
        at, self.levels = 0, []
        for low, high, length, bits in sizes:
            self.levels.append(EliasFano(mapped[at : at + low], mapped[at + low : at + low + high], length, bits))
            at += low + high
        self.codes = mapped[at : at + 2 * n].view("<u2")
        self.count_codes = mapped[at + 2 * n : at + 2 * n + 2 * len(counts)].view("<u2")

    def children(self, context: int) -> int:
        """How many successors a context has, by its pointers."""
        heads, pointers, *_ = self.levels
        place, there = heads.search(np.array([context]))
        return int(np.diff(pointers.at(place[0] + np.arange(2)))[0]) if there[0] else 0

    def place(self, contexts: np.ndarray, successors: np.ndarray, of: np.ndarray, to: np.ndarray) -> np.ndarray:
        """The places of the pairs (contexts[of], successors[to]), -1 of those that the trie has not."""
        heads, _, words, children, *_ = self.levels
        result = np.full(len(of), -1, dtype=np.int64)
        head, known = heads.search(contexts)
        number, there = words.search(successors)
        asked = np.flatnonzero(known[of] & there[to])
        at, hit = children.search(head[of[asked]] * self.universe + number[to[asked]])
        result[asked[hit]] = at[hit]
        return result

    def probabilities(self, places: np.ndarray) -> np.ndarray:
        """Codes of the pairs' probabilities, 0 for the place -1."""
        codes = np.zeros(len(places), dtype="<u2")
        codes[places >= 0] = self.codes[places[places >= 0]]
        return codes

    def counts(self, places: np.ndarray, third: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Codes of the counts of third[to] before the pairs at these places, 0 where the trie has none."""
        before, _, children = self.levels[4:]
        codes = np.zeros(len(places), dtype="<u2")
        number, there = before.search(third)
        asked = np.flatnonzero(there[to] & (places >= 0))
        at, hit = children.search(places[asked] * self.third_universe + number[to[asked]])
        codes[asked[hit]] = self.count_codes[at[hit]]
        return codes
