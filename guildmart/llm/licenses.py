"""License scans by template markup.

A template is compiled into an automaton over words: mandatory words are single steps, an optional
region may be stepped over, a replaceable one takes a bounded number of any words. A place in a text
matches if the automaton, started there, gets through all mandatory wording exactly. A plain phrase
is a template without markup, so both go the same way.

A template's longest run of mandatory words is searched for first, as a string; few texts have one,
and only in those the automata run. Automata are built per task from the templates, a fixed set.

Defined results: missing and empty texts have no words and no match. Repeated rows are scanned each.
A template that could match no word, or begins with a replaceable region, is refused.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guildmart.llm.common import alnum_words, utf8
from guildmart.llm.license_templates import PHRASES, TEMPLATES

_MARKUP = re.compile(r"<<(.*?)>>", re.S)
_RANGE = re.compile(r'match="\{(\d+),(\d+)\}"')


@dataclass
class State:
    words: dict[bytes, int] = field(default_factory=dict)  # word -> next state
    any_word: int | None = None  # next state after any word
    free: list[int] = field(default_factory=list)  # states reached without a word


class Automaton:
    """The compiled template; ``mandatory`` counts its mandatory words, ``anchor`` must be in a text."""

    def __init__(self, label: str, template: str) -> None:
        self.label, self.states = label, [State()]
        self.mandatory, runs, end, opened = 0, [[]], 0, []
        parts = _MARKUP.split(template)
        for i, part in enumerate(parts):
            if i % 2 == 0:
                for word in alnum_words(part.encode()):
                    new = self._state()
                    self.states[end].words[word] = new
                    end = new
                    if not opened:
                        self.mandatory += 1
                        runs[-1].append(word)
                continue
            runs.append([])
            if part == "beginOptional":
                opened.append(end)
                # A state of its own, so that stepping over leaves no other way.
                inner = self._state()
                self.states[end].free.append(inner)
                end = inner
            elif part == "endOptional":
                after = self._state()
                self.states[end].free.append(after)
                self.states[opened.pop()].free.append(after)
                end = after
            elif bounds := _RANGE.search(part):
                low, high = map(int, bounds.groups())
                after = self._state()
                for k in range(high + 1):
                    if k >= low:
                        self.states[end].free.append(after)
                    if k < high:
                        new = self._state()
                        self.states[end].any_word = new
                        end = new
                end = after
            else:
                raise ValueError(f"unknown markup in {label}: {part}")
        if opened or not self.mandatory:
            raise ValueError(f"{label} has an open region or no mandatory word")
        self.accept = end
        self.anchor = b" " + b" ".join(max(runs, key=len)) + b" "
        self.start = self._closed({0})
        if any(self.states[s].any_word is not None for s in self.start):
            raise ValueError(f"{label} begins with a replaceable region")
        self.first = {w for s in self.start for w in self.states[s].words}

    def _state(self) -> int:
        self.states.append(State())
        return len(self.states) - 1

    def _closed(self, states: set[int]) -> frozenset[int]:
        """The states with all that are reached from them without a word."""
        seen, stack = set(states), list(states)
        while stack:
            for other in self.states[stack.pop()].free:
                if other not in seen:
                    seen.add(other)
                    stack.append(other)
        return frozenset(seen)

    def match(self, words: list[bytes], at: int) -> int | None:
        """The end of the longest match that starts at a word, or None."""
        now, end = self.start, None
        for i in range(at, len(words)):
            after = set()
            for s in now:
                state = self.states[s]
                if words[i] in state.words:
                    after.add(state.words[words[i]])
                if state.any_word is not None:
                    after.add(state.any_word)
            if not after:
                break
            now = self._closed(after)
            if self.accept in now:
                end = i + 1
        return end

    def places(self, words: list[bytes], spaced: bytes) -> list[tuple[int, int]]:
        """(start, end) of every place where the template matches."""
        if self.anchor not in spaced:
            return []
        starts = (i for i, w in enumerate(words) if w in self.first)
        return [(i, end) for i in starts if (end := self.match(words, i)) is not None]


class Scanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> None:
        self.phrases = [Automaton(label, phrase) for phrase, label in phrases.items()]
        self.templates = [Automaton(label, template) for label, template in templates.items()]

    def scan(self, text: bytes) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, spans, score.

        Spans are (label, first word, words) of the templates. The score is m / (m + 2), m the most
        mandatory words of a matching phrase or template.
        """
        words = alnum_words(text)
        spaced = b" " + b" ".join(words) + b" "
        base, spans, most = [], [], 0
        for one in self.phrases:
            found = one.places(words, spaced)
            base += [(start, one.label) for start, _ in found]
            most = max(most, one.mandatory if found else 0)
        for one in self.templates:
            found = one.places(words, spaced)
            spans += [(one.label, start, end - start) for start, end in found]
            most = max(most, one.mandatory if found else 0)
        own = {label for _, label in base}
        starts = [start for start, _ in base]
        return (
            len(words),
            len(base),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(own)),
            ",".join(sorted(own | {label for label, _, _ in spans})),
            spans,
            most / (most + 2),
        )


SCANNED = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, spans array<struct<label string, first_word bigint, n_words bigint>>, score double"
)
_NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "spans", "score"]


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of SCANNED; such columns of the input are replaced."""
    kept: list[Scanner] = []

    @F.pandas_udf(SCANNED)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        if not kept:
            kept.append(Scanner())
        found = pd.DataFrame([kept[0].scan(t) for t in texts], columns=_NAMES)
        found["spans"] = [[dict(zip(("label", "first_word", "n_words"), s)) for s in x] for x in found.spans]
        return found.astype({"first_word": "Int64", "last_word": "Int64"})

    own = [c for c in docs.columns if c not in _NAMES and c != "_found"]
    return docs.select(*own, scanned(utf8()).alias("_found")).select(*own, "_found.*")
