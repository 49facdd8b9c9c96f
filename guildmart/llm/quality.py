"""Quality by line labels: a linear-chain CRF marks each line as content or boilerplate.

A line's features are counts of its words and characters and whether it repeats an earlier one. The
CRF scores a sequence of labels by the features' weights per label and by label transitions; Viterbi
decoding gives the best sequence, and the document is kept if lines of content hold at least
``CONTENT_SHARE`` of its words.

There are no labels of lines, so fitting starts from those of documents: all lines of a good one are
content, all of a poor one boilerplate. After a first fit by exact gradients (forward-backward), a
poor document's lines that the model takes for content become content, and it is fitted once more.
It is fitted on about ``MAX_LABELLED`` documents per label, so its size is bounded.

Defined results: missing and empty texts have no words and fail the base rule. Lines without a word
take part in the sequence, but in no share. Repeated rows are judged each. Without labelled
documents of both kinds every line is content.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guildmart.llm.common import Frames
from guildmart.llm.labelled import sample

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CONTENT_SHARE = 0.5
MAX_LABELLED = 3000
MAX_TEXT_BYTES = 50_000
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b"!|#*$%&<>{}=_~^\\"
N_FEATURES = 10


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    words = text.encode("utf-8", "replace").split()
    word_chars = len(text) - sum(map(text.count, SPACES))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """How many words stand in a window of three words that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    inside = np.zeros(len(words), dtype=bool)
    at = np.fromiter((times[w] > 1 for w in windows), dtype=bool, count=len(windows))
    for shift in range(3):
        inside[shift : shift + len(at)] |= at
    return int(inside.sum())


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, words) of the text's lines."""
    lines = text.encode("utf-8", "replace").split(b"\n")
    rows, counts, earlier = [], [], set()
    for line in lines:
        words = line.split()
        n, size = len(words), len(line) or 1
        stripped = line.strip()
        rows.append(
            (
                1.0,
                min(n, 40) / 40,
                1 - len(set(words)) / n if n else 0.0,
                sum(map(eq, words, words[1:])) / n if n else 0.0,
                1 - len(line.translate(None, _UPPER)) / size if line else 0.0,
                1 - len(line.translate(None, _DIGITS)) / size if line else 0.0,
                min(1.0, (len(line) - len(line.translate(None, _MARKS))) / n) if n else 0.0,
                float(stripped in earlier) if n else 0.0,
                float(stripped[-1:] in (b".", b"?", b"!", b'"', b":")),
                float(n == 0),
            )
        )
        counts.append(n)
        earlier.add(stripped)
    return np.array(rows), np.array(counts)


class LineCrf:
    """Two labels, 0 boilerplate and 1 content: weights per label, transitions and a start."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, start: np.ndarray) -> None:
        self.weights, self.moves, self.start = weights, moves, start

    @classmethod
    def neutral(cls) -> LineCrf:
        weights = np.zeros((N_FEATURES, 2))
        weights[0, 1] = 1.0
        return cls(weights, np.zeros((2, 2)), np.zeros(2))

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The best sequence of labels, by Viterbi; ties go to content."""
        scores = (features @ self.weights).tolist()
        (stay0, to1), (to0, stay1) = self.moves.tolist()
        a, b = (s + x for s, x in zip(self.start.tolist(), scores[0]))
        back = []
        for x, y in scores[1:]:
            from0, from1 = a + to1 > b + stay1, a + stay0 > b + to0
            back.append((0 if from1 else 1, 0 if from0 else 1))
            a, b = (a + stay0 if from1 else b + to0) + x, (a + to1 if from0 else b + stay1) + y
        label = 0 if a > b else 1
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return np.array(labels[::-1])

    def sequence_score(self, features: np.ndarray, labels: np.ndarray) -> float:
        own = (features @ self.weights)[np.arange(len(labels)), labels].sum()
        return float(own + self.start[labels[0]] + self.moves[labels[:-1], labels[1:]].sum())


def fit_crf(docs: list[np.ndarray], labels: list[np.ndarray], steps: int = 150, ridge: float = 1e-4) -> LineCrf:
    """Maximum likelihood by full gradients (Adam). Documents are padded to one length per group."""
    order = np.argsort([len(d) for d in docs], kind="stable")
    groups = []
    for part in np.array_split(order, min(len(order), 24)):
        longest = max(len(docs[i]) for i in part)
        x = np.zeros((longest, len(part), N_FEATURES))
        y = np.full((longest, len(part)), -1)
        for k, i in enumerate(part):
            x[: len(docs[i]), k] = docs[i]
            y[: len(docs[i]), k] = labels[i]
        groups.append((x, y))
    theta = np.zeros(N_FEATURES * 2 + 4 + 2)
    mean, square, n = np.zeros_like(theta), np.zeros_like(theta), sum(map(len, docs))
    for step in range(1, steps + 1):
        gradient = sum(_gradient(theta, x, y) for x, y in groups) / n - ridge * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta + 0.15 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return LineCrf(*_unpack(theta))


def _unpack(theta: np.ndarray):
    k = N_FEATURES * 2
    return theta[:k].reshape(N_FEATURES, 2), theta[k : k + 4].reshape(2, 2), theta[k + 4 :]


def _gradient(theta: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of the log-likelihood of the labels ``y`` (length x documents, -1 beyond a document's end)."""
    weights, moves, start = _unpack(theta)
    length, there = len(x), (y >= 0)
    local = x @ weights
    forward, backward = np.zeros_like(local), np.zeros_like(local)
    forward[0] = start + local[0]
    for t in range(1, length):
        new = np.logaddexp.reduce(forward[t - 1][:, :, None] + moves, axis=1) + local[t]
        forward[t] = np.where(there[t][:, None], new, forward[t - 1])
    for t in range(length - 2, -1, -1):
        new = np.logaddexp.reduce(moves + (local[t + 1] + backward[t + 1])[:, None, :], axis=2)
        backward[t] = np.where(there[t + 1][:, None], new, 0.0)
    total = np.logaddexp.reduce(forward[-1], axis=1)
    marginal = np.exp(forward + backward - total[None, :, None]) * there[:, :, None]
    truth = np.stack([(y == 0), (y == 1)], axis=2).astype(float)
    by_weight = np.einsum("tdf,tdk->fk", x, truth - marginal)
    by_move = np.zeros((2, 2))
    for t in range(1, length):
        pair = np.exp(
            forward[t - 1][:, :, None] + moves + (local[t] + backward[t])[:, None, :] - total[:, None, None]
        ) * there[t][:, None, None]
        by_move += np.einsum("di,dj->ij", truth[t - 1] * there[t][:, None], truth[t]) - pair.sum(axis=0)
    by_start = (truth[0] - marginal[0]).sum(axis=0)
    return np.concatenate([by_weight.ravel(), by_move.ravel(), by_start])


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> LineCrf:
    rows = sample(docs, labels, "quality", F.lit(True), max_labelled, MAX_TEXT_BYTES)

    def features(frames: Frames) -> Frames:
        for frame in frames:
            found = [line_features(t)[0].astype("<f4").tobytes() for t in frame.text]
            yield pd.DataFrame({"doc_id": frame.doc_id, "label": frame.label, "features": found})

    found = rows.mapInPandas(features, "doc_id bigint, label int, features binary").toPandas()
    found = found.sort_values(["doc_id", "label"])
    if found.label.nunique() < 2:
        return LineCrf.neutral()
    docs_ = [np.frombuffer(f, dtype="<f4").reshape(-1, N_FEATURES).astype(float) for f in found.features]
    marks = [np.full(len(d), int(q)) for d, q in zip(docs_, found.label)]
    first = fit_crf(docs_, marks)
    again = [m if q else first.decode(d) for d, q, m in zip(docs_, found.label, marks)]
    return fit_crf(docs_, again)


def judge_text(text: str | None, crf: LineCrf) -> tuple:
    counts = base_counts(text or "")
    failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]
    features, words = line_features(text or "")
    content = int(words[crf.decode(features) == 1].sum())
    share = content / counts[0] if counts[0] else 0.0
    return (*counts, failed, share, not failed and share >= CONTENT_SHARE)


JUDGED = [
    "n_words bigint",
    "word_chars bigint",
    "n_symbols bigint",
    "n_dup_lines bigint",
    "n_repeat_words bigint",
    "base_failed boolean",
    "content_share double",
    "kept boolean",
]


def judge(docs: DataFrame, crf: LineCrf) -> DataFrame:
    """``docs`` with the columns of JUDGED; such columns of the input are replaced."""
    names = [c.split()[0] for c in JUDGED]
    shared = docs.sparkSession.sparkContext.broadcast(crf)

    @F.pandas_udf(", ".join(JUDGED))
    def judged(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge_text(t, shared.value) for t in texts], columns=names)

    own = [c for c in docs.columns if c not in names and c != "_judged"]
    return docs.select(*own, judged("text").alias("_judged")).select(*own, "_judged.*")
