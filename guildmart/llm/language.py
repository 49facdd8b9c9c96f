"""Language identification by rank-order profiles of character n-grams.

A language's profile is its ``PROFILE`` most frequent n-grams of one to three letters over all
documents to learn from, in order. A text's ``TOP`` most frequent n-grams are ranked in the same
way, and the language with the smallest out-of-place distance is predicted: the sum over the text's
n-grams of how far their ranks are apart, or ``PROFILE`` if the profile lacks one. N-grams that are
in no profile are out of place alike for all languages and are left out before ranking.

Counting combines n-grams per batch before they are shuffled; the profiles' size is languages times PROFILE. Defined results: texts that are missing or have no
letter are ``und`` with score 0, and so are all if there is nothing to learn from. Ties of distance
go to the first language by code point, ties of frequency to the first n-gram. Repeated rows count
each. Predictions read the text alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from guildmart.llm.common import Frames
from guildmart.llm.labelled import remainder

MAX_N = 3
PROFILE = 400
TOP = 300
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
PIECE_CHARS = 4_000_000
DENSE = 1 << 24  # entries of the largest table that is counted in without sorting


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased words, one 0 before, between and after them."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype="<u4")
    points = np.where(_is_letter()[points], points, 0)
    padded = np.concatenate([[0], points, [0]])
    return padded[np.concatenate([[True], (padded[1:] != 0) | (padded[:-1] != 0)])]


@cache
def _is_letter() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def codes(ids: np.ndarray, base: int) -> list[np.ndarray]:
    """Numbers of the n-grams of one to three characters, by n. Character 0 separates words.

    An n-gram may begin or end with a separator, but has none inside and is not one alone.
    """
    ids = ids.astype(np.int64)
    two = ids[:-1] * base + ids[1:]
    three = two[:-1] * base + ids[2:]
    return [ids[ids > 0], two, three[ids[1:-1] > 0]]


def spell(code: int, n: int, alphabet: np.ndarray) -> str:
    """The n-gram of a number, with _ for a separator."""
    points = []
    for _ in range(n):
        code, at = divmod(code, len(alphabet))
        points.append(int(alphabet[at]))
    return "".join(chr(p) if p else "_" for p in reversed(points))


def count_grams(texts: list[str]) -> dict[str, int]:
    """How often each n-gram is in the texts."""
    points = np.concatenate([letters(t) for t in texts])
    points = points[np.concatenate([[True], (points[1:] != 0) | (points[:-1] != 0)])]
    there = np.zeros(0x110000, dtype=bool)
    there[points] = True
    there[0] = True
    alphabet = np.flatnonzero(there)
    number = np.zeros(0x110000, dtype=np.int32)
    number[alphabet] = np.arange(len(alphabet))
    found = {}
    for n, own in enumerate(codes(number[points], len(alphabet)), 1):
        if len(alphabet) ** n <= DENSE:
            counts = np.bincount(own, minlength=1)
            kinds = np.flatnonzero(counts)
            counts = counts[kinds]
        else:
            kinds, counts = np.unique(own, return_counts=True)
        for code, count in zip(kinds.tolist(), counts.tolist()):
            found[spell(code, n, alphabet)] = count
    return found


@dataclass(frozen=True)
class Profiles:
    langs: list[str]
    index: dict[str, int]  # n-gram -> row of ranks, in order of n-grams
    ranks: np.ndarray  # n-grams x languages, PROFILE where a language lacks the n-gram

    @classmethod
    def of(cls, rows: list[tuple[str, str, int]]) -> Profiles:
        """From (lang, n-gram, rank) rows."""
        langs, found = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
        index = {g: i for i, g in enumerate(found)}
        ranks = np.full((len(found), len(langs)), PROFILE, dtype=np.int64)
        for lang, gram, rank in rows:
            ranks[index[gram], langs.index(lang)] = rank
        return cls(langs, index, ranks)


class Predictor:
    """Counts the profiles' n-grams by a table from their numbers in the profiles' alphabet."""

    def __init__(self, profiles: Profiles) -> None:
        self.profiles = profiles
        # 0 separates words, the last number stands for all letters of no profile.
        alphabet = [0, *sorted({ord(c) for g in profiles.index for c in g if c != "_"})]
        self.base = len(alphabet) + 1
        self.number = np.where(_is_letter(), self.base - 1, 0).astype(np.int32)
        self.number[alphabet] = np.arange(len(alphabet))
        self.tables = []
        for n in range(1, MAX_N + 1):
            grams = [(g, i) for g, i in profiles.index.items() if len(g) == n]
            own = {}
            for gram, i in grams:
                code = 0
                for c in gram:
                    code = code * self.base + (0 if c == "_" else int(self.number[ord(c)]))
                own[code] = i
            keys = np.array(sorted(own), dtype=np.int64)
            rows = np.array([own[k] for k in keys.tolist()], dtype=np.int64)
            if self.base**n <= DENSE:
                dense = np.full(self.base**n, len(profiles.index), dtype=np.int32)
                dense[keys] = rows
                self.tables.append((dense, None))
            else:
                self.tables.append((keys, rows))

    def _rows(self, codes_: np.ndarray, n: int) -> np.ndarray:
        """The profiles' rows of n-gram numbers; one beyond the last for n-grams of no profile."""
        keys, rows = self.tables[n - 1]
        if rows is None:
            return keys[codes_]
        if not len(keys):
            return np.full(len(codes_), len(self.profiles.index))
        at = np.minimum(np.searchsorted(keys, codes_), len(keys) - 1)
        return np.where(keys[at] == codes_, rows[at], len(self.profiles.index))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and how much farther the second one is, as a share of its distance."""
        points = letters(text)
        if len(points) < 2 or not self.profiles.langs:
            return UNKNOWN, 0.0
        size = len(self.profiles.index)
        found = [self._rows(c, n) for n, c in enumerate(codes(self.number[points], self.base), 1)]
        counts = np.bincount(np.concatenate(found), minlength=size + 1)[:size]
        top = np.argsort(-counts, kind="stable")[:TOP]
        top = top[counts[top] > 0]
        ranks = self.profiles.ranks[top]
        distance = np.abs(ranks - np.arange(len(top))[:, None])
        distance = np.where(ranks == PROFILE, PROFILE, distance).sum(axis=0)
        order = np.argsort(distance, kind="stable")
        best = int(distance[order[0]])
        other = int(distance[order[1]]) if len(order) > 1 else PROFILE * max(1, len(top))
        return self.profiles.langs[order[0]], (other - best) / other if other else 0.0


def learn(docs: DataFrame) -> Profiles:
    """Profiles from text and lang of all ``docs`` that have both."""

    def count(frames: Frames) -> Frames:
        for frame in frames:
            # Texts of a few million characters at a time bound the memory.
            piece = frame.text.str.len().cumsum() // PIECE_CHARS
            for (lang, _), own in frame.groupby(["lang", piece]):
                found = count_grams(own.text.tolist())
                yield pd.DataFrame({"lang": lang, "gram": list(found), "n": list(found.values())})

    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    counts = rows.mapInPandas(count, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < PROFILE)
    return Profiles.of([(r.lang, r.gram, r["rank"]) for r in top.collect()])


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; such columns of the input are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    kept: list[Predictor] = []

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        if not kept:
            kept.append(Predictor(shared.value))
        return pd.DataFrame([kept[0].predict(t) for t in texts], columns=["lang_pred", "score"])

    own = [c for c in docs.columns if c not in ("lang_pred", "score", "_found")]
    return docs.select(*own, predicted("text").alias("_found")).select(*own, "_found.*")


def training_documents(docs: DataFrame) -> DataFrame:
    return docs.where(remainder("doc_id", FOLDS) != HELD_OUT)
