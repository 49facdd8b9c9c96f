"""Toxicity by class-conditional Kneser-Ney models of the characters in words.

Each class, toxic and ordinary, has an interpolated model of a character given the five before it in
its word. Both back off to the same Kneser-Ney counts, pooled over the classes, so a rare expression
that neither class has seen says nothing, and a new word with a known beginning says as much as its
beginning. A word's evidence is the difference of its two log-likelihoods. Where both classes back
off, the shared factor cancels, so the fitted model is a table of log-likelihood ratios per n-gram
and, for unseen n-grams, per context.

A document's log-likelihoods are compared normalised by length, over all its words and over its telling
ones: the few strongest, and the share and the sum of those beyond what ordinary words reach. The number
of words is a feature too, as the strongest of many ordinary words is stronger than that of few. A
logistic regression on these, fitted on labelled documents that the models in question were not fitted
on (two folds), gives the score.

The models are fitted on about ``MAX_LABELLED`` documents per class, so they are bounded, whatever
the size of the data, and are broadcast as sorted arrays, which Python workers hold in a few MB. Defined results: missing and empty texts are scored like
texts without a toxic word. Without labelled documents of both classes all scores are 0; if only a fold
lacks a class, fixed weights (``WITHOUT_FOLDS``) stand for fitted ones. Repeated
rows are scored each. Labels, lang and source are never read when scoring.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guildmart.llm.common import Frames, alnum_words
from guildmart.llm.labelled import remainder, sample

ORDER = 6  # at most 8: an n-gram is kept as an integer of 64 bits
DISCOUNT = 0.75
TELLING, TELLING_EVIDENCE, EXCESS = 3, 3.0, 2.5
N_FEATURES = 7
MAX_LABELLED = 6000
MAX_TEXT_BYTES = 100_000
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
CACHE_WORDS = 100_000
START, END = b"\x01", b"\x02"
# The strongest few words alone, where so few documents are labelled that a fold lacks a class.
WITHOUT_FOLDS = np.array([0.0, 1.0, 0.0, 0.0, 0.0, 0.0, -5.0])


def words(text: str | None) -> list[bytes]:
    return alnum_words((text or "").lower().encode("utf-8", "replace"))


def grams(word: bytes, order: int = ORDER) -> list[bytes]:
    """The word's bytes, each with the order - 1 before it; the word is padded at its start."""
    padded = START * (order - 1) + word + END
    return [padded[i : i + order] for i in range(len(word) + 1)]


class Table:
    """Values by byte strings of up to eight bytes and one length, in two sorted arrays."""

    def __init__(self, values: dict[bytes, float]) -> None:
        keys = np.array([int.from_bytes(k) for k in values], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], np.array(list(values.values()), dtype=np.float64)[order]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, whether the table has them)."""
        if not len(self.keys):
            return np.zeros(len(keys)), np.zeros(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return np.where(known, self.values[at], 0.0), known


class Shared:
    """Interpolated Kneser-Ney over the pooled counts; below the top order, of distinct left neighbours."""

    def __init__(self, pooled: Counter, order: int) -> None:
        self.levels: list[Counter] = [Counter() for _ in range(order)] + [pooled]
        for n in range(order - 1, 0, -1):
            self.levels[n].update(g[1:] for g in self.levels[n + 1])
        self.totals = [Counter() for _ in range(order + 1)]
        self.kinds = [Counter() for _ in range(order + 1)]
        for n in range(1, order + 1):
            for gram, count in self.levels[n].items():
                self.totals[n][gram[:-1]] += count
                self.kinds[n][gram[:-1]] += 1
        self.memo: dict[bytes, float] = {}

    def probability(self, gram: bytes) -> float:
        """Of the gram's last byte after the others."""
        if not gram:
            return 1 / 256
        known = self.memo.get(gram)
        if known is None:
            known, n, context = self.probability(gram[1:]), len(gram), gram[:-1]
            if total := self.totals[n].get(context):
                own = max(self.levels[n].get(gram, 0) - DISCOUNT, 0)
                known = (own + DISCOUNT * self.kinds[n][context] * known) / total
            self.memo[gram] = known
        return known


@dataclass(frozen=True)
class Model:
    ratio: Table  # of a seen n-gram
    backoff: Table  # of an unseen one after a seen context
    weights: np.ndarray  # of the logistic regression, intercept last
    order: int = ORDER

    @classmethod
    def fit(cls, counts: tuple[Counter, Counter], order: int = ORDER) -> Model:
        """``counts`` of n-grams of ordinary and of toxic documents; without weights."""
        shared = Shared(counts[0] + counts[1], order)
        totals, left = (Counter(), Counter()), ({}, {})
        for one, total, mass in zip(counts, totals, left):
            kinds = Counter()
            for gram, count in one.items():
                total[gram[:-1]] += count
                kinds[gram[:-1]] += 1
            mass.update({c: DISCOUNT * kinds[c] / total[c] for c in total})
        ratio = {}
        for gram in shared.levels[order]:
            context, lower, logs = gram[:-1], shared.probability(gram), []
            for one, total, mass in zip(counts, totals, left):
                seen = total.get(context)
                own = max(one.get(gram, 0) - DISCOUNT, 0) / seen if seen else 0.0
                logs.append(math.log(own + mass.get(context, 1.0) * lower))
            ratio[gram] = logs[1] - logs[0]
        backoff = {c: math.log(left[1].get(c, 1.0) / left[0].get(c, 1.0)) for c in totals[0] | totals[1]}
        return cls(Table(ratio), Table(backoff), np.zeros(N_FEATURES), order)

    def evidences(self, found: list[bytes]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of each word."""
        padding = START * (self.order - 1)
        text = np.frombuffer(b"".join([padding + w + END for w in found]), dtype=np.uint8).astype(np.uint64)
        sizes = np.array([len(w) + 1 for w in found])
        first = np.cumsum(sizes) - sizes
        starts = np.arange(sizes.sum()) + np.repeat(np.arange(len(found)), sizes) * (self.order - 1)
        contexts = np.zeros(len(starts), dtype=np.uint64)
        for i in range(self.order - 1):
            contexts = contexts << np.uint64(8) | text[starts + i]
        ratio, known = self.ratio.find(contexts << np.uint64(8) | text[starts + self.order - 1])
        return np.add.reduceat(np.where(known, ratio, self.backoff.find(contexts)[0]), first)

    def evidence(self, word: bytes) -> float:
        return float(self.evidences([word])[0])


class Scorer:
    """A model with a bounded memory of words met."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}

    def features(self, text: str | None) -> np.ndarray:
        """Differences of the length-normalised log-likelihoods: of all words, the strongest few and the
        strongest; the number of words; and the share and the sum of telling words."""
        known, found = self.known, words(text)
        if not found:
            return np.append(np.zeros(N_FEATURES - 1), 1.0)
        if len(known) > CACHE_WORDS:
            known.clear()
        if new := [w for w in dict.fromkeys(found) if w not in known]:
            known.update(zip(new, self.model.evidences(new).tolist()))
        values = np.array([known[w] for w in found])
        telling = np.partition(values, -TELLING)[-TELLING:] if len(values) > TELLING else values
        beyond = np.maximum(values - EXCESS, 0).sum()
        share = 10 * math.sqrt((values > TELLING_EVIDENCE).mean())
        return np.array([values.mean(), telling.sum() / TELLING, values.max(), math.log1p(len(values)), share, math.log1p(beyond), 1.0])

    def score(self, text: str | None) -> float:
        at = float(np.clip(self.features(text) @ self.model.weights, -40, 40))
        return 1 / (1 + math.exp(-at))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights by Newton's method, with both classes weighing the same; the intercept, last, is not shrunk."""
    weights, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    each = np.where(y == 1, len(y) / (2 * max(1, (y == 1).sum())), len(y) / (2 * max(1, (y == 0).sum())))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
        hessian = x.T @ (x * (each * p * (1 - p))[:, None]) + penalty
        step = np.linalg.solve(hessian, x.T @ (each * (y - p)) - penalty @ weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model | None:
    """The model of the documents outside the held-out third; None without both classes."""
    spark = docs.sparkSession
    chosen = remainder("doc_id", FOLDS) != HELD_OUT
    rows = sample(docs, labels, "toxic", chosen, max_labelled, MAX_TEXT_BYTES)
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(2)).cast("int"))

    def count(frames: Frames) -> Frames:
        found: dict[tuple[int, int], Counter] = {}
        for frame in frames:
            for text, label, fold in zip(frame.text, frame.label, frame.fold):
                found.setdefault((int(fold), int(label)), Counter()).update(words(text))
        for (fold, label), own in found.items():
            total: Counter = Counter()
            for word, n in own.items():
                for gram in grams(word):
                    total[gram] += n
            yield pd.DataFrame({"fold": fold, "label": label, "gram": list(total), "n": list(total.values())})

    counted = rows.mapInPandas(count, "fold int, label int, gram binary, n bigint")
    summed = counted.groupBy("fold", "label", "gram").agg(F.sum("n").alias("n"))
    counts: dict[tuple[int, int], Counter] = {}
    for row in summed.toLocalIterator():
        counts.setdefault((row.fold, row.label), Counter())[bytes(row.gram)] = row.n
    both = tuple(counts.get((0, c), Counter()) + counts.get((1, c), Counter()) for c in (0, 1))
    if not both[0] or not both[1]:
        return None
    model = Model.fit(both)
    del both
    if len(counts) < 4:
        return replace(model, weights=WITHOUT_FOLDS)
    # The model of one fold is applied to the other one.
    crossed = spark.sparkContext.broadcast([Model.fit((counts.pop((1 - f, 0)), counts.pop((1 - f, 1)))) for f in (0, 1)])

    def features(frames: Frames) -> Frames:
        scorers = [Scorer(m) for m in crossed.value]
        for frame in frames:
            x = np.array([scorers[f].features(t) for t, f in zip(frame.text, frame.fold)]).reshape(-1, N_FEATURES)
            yield pd.DataFrame({**dict(zip(names, x.T)), "y": frame.label.astype(float)})

    names = [f"x{i}" for i in range(N_FEATURES)]
    x = rows.mapInPandas(features, ", ".join(f"{n} double" for n in (*names, "y"))).toPandas()
    crossed.destroy()
    x = x.sort_values([*names, "y"]).to_numpy()
    return replace(model, weights=logistic(x[:, :N_FEATURES], x[:, N_FEATURES]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; such columns of the input are replaced."""
    if model is None:
        scored = F.lit(0.0)
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        kept: list[Scorer] = []

        @F.pandas_udf("double")
        def scored_texts(texts: pd.Series) -> pd.Series:
            if not kept:
                kept.append(Scorer(shared.value))
            return pd.Series([kept[0].score(t) for t in texts])

        scored = scored_texts("text")
    own = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*own, scored.alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def ordinary_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted to be toxic."""
    own = [F.col("row")[c].alias(c) for c in docs.columns]
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return score(rows, fit(docs, labels)).where("predicted = 0").select(*own)
