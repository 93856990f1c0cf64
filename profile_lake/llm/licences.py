"""Licence scan: matching statistics against an automaton of licence templates.

The templates' words form one generalised suffix automaton, small and fixed by its
templates. A file's words stream through it; at every word the automaton knows the
longest stretch ending there that occurs in some template. Long stretches are then
chained, per template and in template order, into covered spans. A template that is
covered far enough gives its label and the words it spans.

Words before streaming: only stretches of which every word pair occurs in a template
can match two words or more, so the rest of a text is passed over by array lookups.

Null or empty text: no words, no label, score 0. Repeated rows: each gets its result.
Ties between spans go to the earliest. Empty table: empty result. Other columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profile_lake.llm.batches import NON_ALNUM_BYTES, Rolling, Words, map_texts

# Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Opening words of public licence notices, and their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation": "gpl-notice",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
}

#: Words a match needs to take part in a chain.
MIN_MATCH = 3
#: Words that may lie between two matches of a chain.
MAX_GAP = 8
#: Part of a template that a chain has to cover.
MIN_COVER = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    #: A phrase has to stand whole; every place counts.
    exact: bool


def standard_templates() -> list[Template]:
    return [Template(label, tuple(text.split()), True) for text, label in PHRASES.items()] + [
        Template(label, tuple(text.split()), False) for text, label in NOTICES.items()
    ]


@dataclass
class _State:
    length: int
    link: int = -1
    next: dict[int, int] = field(default_factory=dict)
    #: Where in templates the state's strings end: (template, words up to there).
    ends: set[tuple[int, int]] = field(default_factory=set)


class SuffixAutomaton:
    """Generalised suffix automaton of several word sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.states = [_State(0)]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence, 1):
                last = self._extended(last, word)
                self.states[last].ends.add((number, at))
        for state in sorted(range(1, len(self.states)), key=lambda s: -self.states[s].length):
            link = self.states[state].link
            if link > 0:
                self.states[link].ends |= self.states[state].ends

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` for the strings that ``state`` and shorter ones reach."""
        old = self.states[target]
        self.states.append(_State(self.states[state].length + 1, old.link, dict(old.next)))
        copy = len(self.states) - 1
        old.link = copy
        while state >= 0 and self.states[state].next.get(word) == target:
            self.states[state].next[word] = copy
            state = self.states[state].link
        return copy

    def _extended(self, last: int, word: int) -> int:
        target = self.states[last].next.get(word)
        if target is not None:
            fits = self.states[target].length == self.states[last].length + 1
            return target if fits else self._split(last, word, target)
        self.states.append(_State(self.states[last].length + 1))
        new, state = len(self.states) - 1, last
        while state >= 0 and word not in self.states[state].next:
            self.states[state].next[word] = new
            state = self.states[state].link
        if state < 0:
            self.states[new].link = 0
            return new
        target = self.states[state].next[word]
        fits = self.states[target].length == self.states[state].length + 1
        self.states[new].link = target if fits else self._split(state, word, target)
        return new

    def statistics(self, words: list[int]) -> list[tuple[int, int]]:
        """At every word: the state, and the length of the longest match ending there."""
        out, state, length = [], 0, 0
        for word in words:
            while state and word not in self.states[state].next:
                state = self.states[state].link
                length = self.states[state].length
            if word in self.states[state].next:
                state = self.states[state].next[word]
                length += 1
            out.append((state, length))
        return out


@dataclass(frozen=True)
class Span:
    """A template found in a text: words ``first`` to ``last``, and the part covered."""

    template: int
    first: int
    last: int
    cover: float


class LicenceScanner:
    """The automaton of some templates, and the scan of a slice of texts with it."""

    def __init__(self, templates: list[Template]):
        self.templates = templates
        vocabulary = sorted({w for t in templates for w in t.words})
        self._ids = {w: i for i, w in enumerate(vocabulary)}
        sequences = [[self._ids[w] for w in t.words] for t in templates]
        self.automaton = SuffixAutomaton(sequences)
        known = Words(pa.array(vocabulary, pa.string()), NON_ALNUM_BYTES).hashes()
        self._order = np.argsort(known)
        self._known = known[self._order]
        self._pairs = np.zeros((len(vocabulary) + 1, len(vocabulary) + 1), bool)
        for s in sequences:
            self._pairs[s[:-1], s[1:]] = True

    def _word_ids(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self._known, hashes), len(self._known) - 1)
        return np.where(self._known[at] == hashes, self._order[at], len(self._known))

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, list[list[Span]]]:
        """The number of words and the spans of each text."""
        words = Words(texts, NON_ALNUM_BYTES, lower=True)
        n = int(words.first[-1])
        ids = self._word_ids(Rolling(words.data).of(words.starts, words.ends))
        paired = np.zeros(n, bool)
        if n > 1:
            paired[:-1] = self._pairs[ids[:-1], ids[1:]]
            last = words.first[1:-1] - 1
            paired[last[last >= 0]] = False
        found: list[list[Span]] = [[] for _ in range(len(texts))]
        starts, ends = spans_of(paired)
        matches: dict[int, list[tuple[int, int, int, int]]] = {}
        for a, b in zip(starts.tolist(), ends.tolist()):
            text = int(np.searchsorted(words.first, a, "right")) - 1
            stretch = ids[a : b + 1].tolist()
            matches.setdefault(text, []).extend(self._matches(stretch, a - int(words.first[text])))
        for text, hits in matches.items():
            found[text] = self._spans(hits)
        return words.counts, found

    def _matches(self, stretch: list[int], first: int) -> list[tuple[int, int, int, int]]:
        """(template, its word, the text's word, length) of maximal matches and whole phrases."""
        stats = self.automaton.statistics(stretch)
        out = []
        for at, (state, length) in enumerate(stats):
            longest = at + 1 == len(stats) or stats[at + 1][1] <= length
            for template, end in self.automaton.states[state].ends:
                size = len(self.templates[template].words)
                if self.templates[template].exact:
                    continue
                if longest and length >= min(MIN_MATCH, size):
                    out.append((template, end - length, first + at + 1 - length, length))
            out += self._phrases(state, length, first + at + 1)
        return out

    def _phrases(self, state: int, length: int, end: int) -> list[tuple[int, int, int, int]]:
        """Exact templates that are suffixes of the match: they lie on the suffix links."""
        out = []
        while state > 0:
            for template, at in self.automaton.states[state].ends:
                size = len(self.templates[template].words)
                if self.templates[template].exact and at == size:
                    low = self.automaton.states[self.automaton.states[state].link].length
                    if low < size <= min(length, self.automaton.states[state].length):
                        out.append((template, 0, end - size, size))
            state = self.automaton.states[state].link
        return out

    def _spans(self, hits: list[tuple[int, int, int, int]]) -> list[Span]:
        out = []
        for template in sorted({h[0] for h in hits}):
            size = len(self.templates[template].words)
            own = sorted((at, in_template, length) for t, in_template, at, length in hits if t == template)
            if self.templates[template].exact:
                out += [Span(template, at, at + size - 1, 1.0) for at, _, _ in own]
            else:
                out += self._chained(template, size, own)
        return sorted(out, key=lambda s: (s.first, s.last, s.template))

    @staticmethod
    def _chained(template: int, size: int, own: list[tuple[int, int, int]]) -> list[Span]:
        """Open chains are extended by the next match that goes on in text and template."""
        chains: list[list[int]] = []  # first word, next word, next template word, covered
        for at, in_template, length in own:
            fitting = [
                c for c in chains if 0 <= at + length - c[1] and at - c[1] <= MAX_GAP and in_template + length > c[2]
            ]
            if fitting:
                best = max(fitting, key=lambda c: (c[3], -c[0]))
                best[3] += in_template + length - max(best[2], in_template)
                best[1], best[2] = at + length, in_template + length
            else:
                chains.append([at, at + length, in_template + length, length])
            chains = [c for c in chains if at - c[1] <= MAX_GAP or c[3] >= MIN_COVER * size]
        return [Span(template, a, b - 1, min(1.0, c / size)) for a, b, _, c in chains if c >= MIN_COVER * size]


def spans_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


SPANS = "array<struct<label:string,exact:boolean,first_word:int,last_word:int,cover:double>>"


def scan_licences(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """doc_id, n_words and the licence spans of every document, by first word."""
    made = templates or standard_templates()
    cache: list[LicenceScanner] = []
    kind = pa.list_(
        pa.struct(
            [("label", pa.string()), ("exact", pa.bool_()), ("first_word", pa.int32()), ("last_word", pa.int32()),
             ("cover", pa.float64())]
        )
    )

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        if not cache:
            cache.append(LicenceScanner(made))
        counts, found = cache[0].scan(part.column(1))
        rows = [
            [
                {"label": made[s.template].label, "exact": made[s.template].exact, "first_word": s.first,
                 "last_word": s.last, "cover": s.cover}
                for s in each
            ]
            for each in found
        ]
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(counts.astype(np.int64)), pa.array(rows, kind)], ["doc_id", "n_words", "spans"]
        )

    return map_texts(
        docs.select(F.col("doc_id").cast("long"), "text"), work, f"doc_id long, n_words long, spans {SPANS}"
    )
