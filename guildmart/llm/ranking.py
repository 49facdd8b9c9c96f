"""Document quality by Bradley-Terry ranking of labelled documents.

A document's strength is linear in features of its writing: how long, varied and repetitive its words
and lines are, and which characters they are made of. A document labelled 1 is preferred to one labelled
0; the weights maximise the likelihood that in each drawn pair the preferred one wins, a logistic loss
on the difference of the two documents' features. Strengths only order documents, so the threshold is
set by quantiles: it lies where the share q of good documents below it equals the share of poor ones
above it, by the strengths of all labelled documents, and a score of 0.7 stands for it.

Features of every text are computed once and written, a hundredth of the text's size or so. Weights are
fitted on a sample of about ``MAX_LABELLED`` documents per label, each in ``PARTNERS`` pairs; quantiles
are taken by Spark over all labelled documents outside the held-out part.

Defined results: missing and empty texts have the features of a text without words, and a score. Without
documents of both labels all scores are 0. Rows of one doc_id are scored each; equal rows count once in
fitting. Labels, lang, source and doc_id are never read when scoring. An empty table has no rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guildmart.llm.common import join_keyed
from guildmart.llm.labelled import FULL, remainder
from guildmart.sources.warehouse import written

MAX_LABELLED = 3000
PARTNERS = 8
RIDGE = 1.0  # per 1000 pairs
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
GRID = 1000
SEED = 12

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"#*$%&|<>@^~=_{}[]\\/+"
_LOUD = b"!?"
_ENDS = b".!?:\"'"

NAMES = (
    "log words", "log lines", "words a line", "word size", "word size spread", "distinct words", "top word",
    "same neighbours", "repeated threes", "equal lines", "empty lines", "upper", "digits", "symbols", "loud",
    "letters", "capital words", "upper words", "marked words", "line ends", "sentences", "one-letter words",
    "long words", "entropy",
)


def features(text: str | None) -> np.ndarray:
    """The features of a text, in the order of NAMES, all of the size of one."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n, size = len(words), max(1, len(raw) - raw.count(b" ") - raw.count(b"\n"))
    if not n:
        return np.zeros(len(NAMES))
    lines = [line.strip() for line in raw.split(b"\n")]
    full = [line for line in lines if line]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    times = Counter(words)
    threes = Counter(zip(words, words[1:], words[2:]))
    share = lambda chars: 1 - len(raw.translate(None, chars)) / len(raw)
    bytes_of = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    shares = bytes_of[bytes_of > 0] / len(raw)
    return np.array(
        [
            np.log1p(n) / 5,
            np.log1p(len(full)) / 3,
            np.log1p(n / len(full)) / 3,
            lengths.mean() / 6,
            lengths.std() / 6,
            len(times) / n,
            max(times.values()) / n,
            sum(map(bytes.__eq__, words, words[1:])) / n,
            sum(c for c in threes.values() if c > 1) / n,
            1 - len(set(full)) / len(full),
            1 - len(full) / len(lines),
            share(_UPPER),
            share(_DIGITS),
            min(1.0, (len(raw) - len(raw.translate(None, _SYMBOLS))) / n),
            min(1.0, (len(raw) - len(raw.translate(None, _LOUD))) / n),
            (len(raw) - len(raw.translate(None, _LETTERS))) / size,
            sum(w[0] in _UPPER for w in words) / n,
            sum(w.isupper() for w in words) / n,
            sum(w[-1] in _SYMBOLS or w[-1] in _LOUD for w in words) / n,
            sum(line[-1] in _ENDS for line in full) / len(full),
            min(1.0, sum(w[-1] in _ENDS for w in words) / n),
            float((lengths == 1).mean()),
            float((lengths > 20).mean()),
            float(-(shares * np.log2(shares)).sum()) / 5,
        ]
    )


@dataclass(frozen=True)
class Ranker:
    weights: np.ndarray
    cut: float = 0.0

    def strength(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1, and THRESHOLD for a document that is as strong as the cut."""
        odds = THRESHOLD / (1 - THRESHOLD)
        return 1 / (1 + np.exp(-np.clip(self.strength(x) - self.cut, -35, 35)) / odds)

    def cut_at(self, cut: float) -> Ranker:
        return replace(self, cut=float(cut))


def pairs(good: int, poor: int, partners: int = PARTNERS) -> tuple[np.ndarray, np.ndarray]:
    """Places of the preferred and of the other document of each pair; every document is in ``partners``
    pairs at least."""
    rng = np.random.default_rng(SEED)
    n = max(good, poor) * partners
    order = [np.concatenate([rng.permutation(size) for _ in range(-(-n // size))])[:n] for size in (good, poor)]
    return order[0], order[1]


def bradley_terry(good: np.ndarray, poor: np.ndarray, ridge: float = RIDGE, steps: int = 50) -> Ranker:
    """The weights under which the good documents most likely win their pairs, by Newton's method."""
    first, second = pairs(len(good), len(poor))
    x = good[first] - poor[second]
    penalty = ridge * len(x) / 1000
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        lose = 1 / (1 + np.exp(np.clip(x @ weights, -35, 35)))
        hessian = x.T @ (x * (lose * (1 - lose))[:, None]) + penalty * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, x.T @ lose - penalty * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return Ranker(weights)


def threshold(good: np.ndarray, poor: np.ndarray) -> float:
    """Where as many good documents are below as poor ones above, of both labels' quantiles in equal steps."""
    best = int(np.argmax(good >= poor[::-1]))
    return float((good[best] + poor[::-1][best]) / 2)


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` with the features of ``text`` as 32-bit floats; a column of that name is replaced."""

    @F.pandas_udf("binary")
    def computed(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).astype("<f4").tobytes() for t in texts])

    return docs.withColumn("features", computed("text"))


def _matrix(blobs) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, blobs)), dtype="<f4").reshape(-1, len(NAMES)).astype(float)


def _strengths(ranker: Ranker):
    @F.pandas_udf("double")
    def strength(blobs: pd.Series) -> pd.Series:
        return pd.Series(ranker.strength(_matrix(blobs)))

    return strength


def labelled(rows: DataFrame, labels: DataFrame, chosen) -> DataFrame:
    """The distinct (doc_id, label, features) of the labelled documents that ``chosen``, a condition on
    doc_id, takes; of written rows with doc_id and features. A document labelled twice has two."""
    named = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    named = named.where(chosen & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).distinct()
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "features").where("doc_id is not null")
    held = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    # One doc_id may hold a third of the rows, so the most frequent ones are broadcast.
    found = join_keyed(rows, written(named.join(held, "doc_id")), ["doc_id"], "inner", rows.count(), "n")
    return found.groupBy("doc_id", "label", "features").agg(F.count(F.lit(1)).alias("rows"))


def fit(rows: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Ranker | None:
    """The ranker of the labelled documents outside the held-out part; None without both labels."""
    known = written(labelled(rows, labels, remainder("doc_id", FOLDS) != HELD_OUT))
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col("label") == value, int(min(1.0, max_labelled / n) * FULL)).otherwise(share)
    picked = known.where(F.pmod(F.xxhash64("doc_id", "features", F.lit(SEED)), F.lit(FULL)) < share)
    # About 2 * max_labelled rows of a hundred bytes, whatever the size of the data.
    found = sorted((r.label, r.doc_id, bytes(r.features)) for r in picked.select("label", "doc_id", "features").collect())
    good, poor = (_matrix(f for label, _, f in found if label == value) for value in (1, 0))
    if not len(good) or not len(poor):
        return None
    ranker = bradley_terry(good, poor)
    steps = [i / GRID for i in range(GRID + 1)]
    strong = known.select("label", _strengths(ranker)("features").alias("strength"))
    grids = strong.groupBy("label").agg(F.percentile_approx("strength", steps, 100 * GRID).alias("grid")).collect()
    of = {r.label: np.array(r.grid) for r in grids}
    return ranker.cut_at(threshold(of[1], of[0]))


def score(rows: DataFrame, ranker: Ranker | None) -> DataFrame:
    """``rows``, which have ``features``, with ``score`` and ``predicted`` in their place."""
    if ranker is None:
        scored = F.lit(0.0)
    else:

        @F.pandas_udf("double")
        def scores(blobs: pd.Series) -> pd.Series:
            return pd.Series(ranker.score(_matrix(blobs)))

        scored = scores("features")
    own = [c for c in rows.columns if c not in ("features", "score", "predicted")]
    return rows.select(*own, scored.alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the ranker predicts to be good, with their columns."""
    ranker = fit(written(with_features(docs.select("doc_id", "text")).drop("text")), labels)
    own = [F.col("row")[c].alias(c) for c in docs.columns]
    rows = with_features(docs.select(F.struct(*docs.columns).alias("row"), "text")).drop("text")
    return score(rows, ranker).where("predicted = 1").select(*own)
