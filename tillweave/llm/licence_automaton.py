"""Licence scan with a generalised suffix automaton of licence words.

The automaton knows every run of words of every template.  A text streams
through it word by word; the state and the length of the longest run that ends
at a word are its matching statistics.  Long matches, at each of their places in
each template, are chained in the order of both the text and the template into
the spans of the text that cover it.  Short phrases go into the same automaton, names
into one of their own: a phrase ends at a word if its state lies on the suffix
links of the state there and the match is as long.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillweave.llm import words as W

#: Phrases that label a text by themselves (fixed values).
PHRASES: dict[str, str] = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Short names of licences as files declare them (fixed values); the name is the label.
SPDX_NAMES = (
    "agpl-3.0-only", "agpl-3.0-or-later", "apache-1.1", "apache-2.0", "artistic-2.0",
    "bsd-2-clause", "bsd-3-clause", "bsd-4-clause", "bsl-1.0", "cc-by-3.0", "cc-by-4.0",
    "cc-by-nc-4.0", "cc-by-nc-nd-4.0", "cc-by-nc-sa-4.0", "cc-by-nd-4.0", "cc-by-sa-3.0",
    "cc-by-sa-4.0", "cc0-1.0", "epl-1.0", "epl-2.0", "eupl-1.2", "gpl-2.0", "gpl-2.0-only",
    "gpl-2.0-or-later", "gpl-3.0", "gpl-3.0-only", "gpl-3.0-or-later", "isc", "lgpl-2.1",
    "lgpl-2.1-only", "lgpl-2.1-or-later", "lgpl-3.0", "lgpl-3.0-only", "lgpl-3.0-or-later",
    "mit", "mit-0", "mpl-1.1", "mpl-2.0", "ms-pl", "odbl-1.0", "ofl-1.1", "unlicense",
    "wtfpl", "zlib",
)

#: What stands before "license" where a text says that it is under one (fixed values), by label.
SPOKEN_NAMES: dict[str, str] = {
    "mit": "mit",
    "isc": "isc",
    "zlib": "zlib",
    "bsd": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "simplified bsd": "bsd-2-clause",
    "new bsd": "bsd-3-clause",
    "boost software": "bsl-1.0",
    "eclipse public": "epl",
    "mozilla public": "mpl",
    "apache": "apache",
    "open database": "odbl-1.0",
    "sil open font": "ofl-1.1",
}


def licence_names() -> dict[str, str]:
    """Wordings that name a licence, each to be found whole, with their labels."""
    names = {f"spdx license identifier {name}": name for name in SPDX_NAMES}
    for spoken, label in SPOKEN_NAMES.items():
        for verb in ("licensed", "released", "distributed", "available"):
            names[f"{verb} under the {spoken} license"] = label
    return names


#: Notices as their licences ask them to be given (fixed values), by label.
TEMPLATES: dict[str, str] = {
    "agpl-notice": (
        "you can redistribute it and or modify it under the terms of the gnu affero general"
        " public license as published by the free software foundation"
    ),
    "apache-2.0": "licensed under the apache license version 2.0",
    "apache-2.0-notice": (
        "licensed under the apache license version 2.0 the license you may not use this file"
        " except in compliance with the license you may obtain a copy of the license at"
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met"
    ),
    "bsd-3-clause": (
        "neither the name of the copyright holder nor the names of its contributors may be used"
        " to endorse or promote products derived from this software without specific prior"
        " written permission"
    ),
    "bsd-disclaimer": (
        "this software is provided by the copyright holders and contributors as is and any"
        " express or implied warranties including but not limited to the implied warranties of"
        " merchantability and fitness for a particular purpose are disclaimed"
    ),
    "bsl-1.0": (
        "permission is hereby granted free of charge to any person or organization obtaining a"
        " copy of the software and accompanying documentation covered by this license"
    ),
    "cc-by-4.0": "this work is licensed under a creative commons attribution 4.0 international license",
    "cc-by-nc": "licensed under cc by nc 4.0",
    "cc-by-sa": "licensed under cc by sa 4.0",
    "cc-by-sa-4.0": (
        "this work is licensed under a creative commons attribution sharealike 4.0 international"
        " license"
    ),
    "cc0-1.0": (
        "to the extent possible under law the author has waived all copyright and related or"
        " neighboring rights to this work"
    ),
    "gfdl": (
        "permission is granted to copy distribute and or modify this document under the terms of"
        " the gnu free documentation license"
    ),
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": (
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu general public license as published by the free software foundation"
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted"
    ),
    "lgpl-notice": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general"
        " public license as published by the free software foundation"
    ),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files the software to deal in the software"
        " without restriction"
    ),
    "mit-short": "released under the mit license",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "zlib": (
        "permission is granted to anyone to use this software for any purpose including"
        " commercial applications and to alter it and redistribute it freely"
    ),
}


def split_words(text: str) -> list[bytes]:
    mapped = W.PLAIN[np.frombuffer(text.encode("utf-8"), np.uint8)]
    return np.where(mapped == W.GAP, 0x20, mapped).astype(np.uint8).tobytes().split()


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with the places of every state."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        at: list[list[tuple[int, int]]] = []
        for number, sequence in enumerate(sequences):
            last = 0
            for end, word in enumerate(sequence):
                last = self._extend(last, word)
                at += [[] for _ in range(len(self.next) - len(at))]
                at[last].append((number, end))
        self._order_places(at)

    def _order_places(self, at: list[list[tuple[int, int]]]) -> None:
        """Ends of all sequences' runs so that those of a state are next to each other.

        The places of a state are its own and those of the states that link to
        it: a branch of the tree of suffix links, and so a stretch of its preorder.
        """
        below: list[list[int]] = [[] for _ in self.next]
        for state in range(1, len(self.next)):
            below[self.link[state]].append(state)
        self._places: list[tuple[int, int]] = []
        self._stretch = [(0, 0)] * len(self.next)
        stack = [(0, -1)]
        while stack:
            state, begin = stack.pop()
            if begin >= 0:
                self._stretch[state] = (begin, len(self._places))
                continue
            stack.append((state, len(self._places)))
            if state < len(at):
                self._places += at[state]
            stack += [(s, -1) for s in below[state]]

    def places(self, state: int) -> list[tuple[int, int]]:
        """(sequence, end) of every occurrence of the state's runs."""
        low, high = self._stretch[state]
        return self._places[low:high]

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, word: int) -> int:
        twin = self._state(self.length[p] + 1)
        self.next[twin] = dict(self.next[q])
        self.link[twin] = self.link[q]
        self.link[q] = twin
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, word)
        state = self._state(self.length[last] + 1)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[state] = (
                q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word)
            )
        return state

    def find(self, sequence: Sequence[int]) -> int:
        state = 0
        for word in sequence:
            state = self.next[state][word]
        return state

    def whole(self, sequences: Sequence[Sequence[int]]) -> list[tuple[tuple[int, int], ...]]:
        """Per state the (number, length) of those ``sequences`` that are on its suffix links."""
        at: dict[int, list[tuple[int, int]]] = {}
        for number, sequence in enumerate(sequences):
            at.setdefault(self.find(sequence), []).append((number, len(sequence)))
        held: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        for state in sorted(range(1, len(held)), key=self.length.__getitem__):
            held[state] = (*at.get(state, ()), *held[self.link[state]])
        return held

    def statistics(self, sequence: Sequence[int]) -> Iterator[tuple[int, int]]:
        """Per word: the state and length of the longest known run that ends there."""
        state, length = 0, 0
        following, link, longest = self.next, self.link, self.length
        for word in sequence:
            while state and word not in following[state]:
                state = link[state]
                length = longest[state]
            if word in following[state]:
                state = following[state][word]
                length += 1
            yield state, length


class LicenceScanner:
    """Scans runs of licence words; a text's other words end a run."""

    def __init__(
        self,
        templates: Mapping[str, str],
        phrases: Mapping[str, str],
        names: Mapping[str, str],
        min_match: int,
        max_gap: int,
        min_cover: float,
    ):
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover
        self.labels = list(templates)
        self.phrase_labels, self.name_labels = list(phrases.values()), list(names.values())
        notices = [split_words(t) for t in [*templates.values(), *phrases]]
        called = [split_words(t) for t in names]
        known = dict.fromkeys(w for s in [*notices, *called] for w in s)
        self.vocabulary = {w: i for i, w in enumerate(known)}
        coded = [[self.vocabulary[w] for w in s] for s in notices]
        self.sizes = [len(s) for s in coded]
        self.automaton = SuffixAutomaton(coded)
        self.phrases_at = self.automaton.whole(coded[len(self.labels) :])
        # Names have an automaton of their own: in the other they would outrun templates.
        coded_names = [[self.vocabulary[w] for w in s] for s in called]
        self.names = SuffixAutomaton(coded_names)
        self.names_at = self.names.whole(coded_names)
        self.in_all_names = set.intersection(*map(set, coded_names)) if coded_names else set()
        self.shortest = min([min_match, *map(len, coded[len(self.labels) :]), *map(len, coded_names)])

    def scan(
        self, run: Sequence[int], offset: int, phrases: list, names: list, matches: list
    ) -> None:
        """Append (phrase, first word), (name, first word) and (template, first word, end, place in it)."""
        automaton = self.automaton
        stats = list(automaton.statistics(run))
        for i, (state, length) in enumerate(stats):
            for phrase, size in self.phrases_at[state]:
                if size <= length:
                    phrases.append((phrase, offset + i + 1 - size))
            # A match is reported where it cannot be made longer.
            if length >= self.min_match and (
                i + 1 == len(stats) or stats[i + 1][1] <= length
            ):
                for template, end in automaton.places(state):
                    if template < len(self.labels):
                        matches.append(
                            (template, offset + i + 1 - length, offset + i + 1, end + 1 - length)
                        )
        if self.name_labels and self.in_all_names.issubset(run):
            longest: dict[int, tuple[int, int]] = {}
            for i, (state, length) in enumerate(self.names.statistics(run)):
                for name, size in self.names_at[state]:
                    if size <= length:
                        first = offset + i + 1 - size
                        longest[first] = max(longest.get(first, (0, 0)), (size, name))
            names += [(name, first) for first, (_, name) in longest.items()]

    def chained(self, matches: list) -> tuple[float, list[tuple[int, int, int, float]]]:
        """Greatest covered share of any chain, and (template, first word, end, share) of the spans.

        The spans of a template are chains of ``min_cover`` and more that do not
        overlap and cover the most words of it together.
        """
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for template, *match in matches:
            by_template.setdefault(template, []).append(tuple(match))
        best, spans = 0.0, []
        for template, own in sorted(by_template.items()):
            size = self.sizes[template]
            chains = chains_of(own, self.max_gap)
            best = max([best, *(covered / size for *_, covered in chains)])
            full = [c for c in chains if c[2] / size >= self.min_cover]
            spans += [(template, a, b, covered / size) for a, b, covered in apart(full)]
        return best, spans


def chains_of(matches: Sequence[tuple[int, int, int]], max_gap: int) -> list[tuple[int, int, int]]:
    """(first word, end, covered words) of the chains of (first word, end, place in the template).

    A match goes on with a chain that ends at most ``max_gap`` words before it,
    for the words of it that lie behind the chain's in both the text and the
    template.  Per last match, of the chains from one first word the one that
    covers the most, and of two chains the shorter if it covers as much.
    """
    order = sorted(matches, key=lambda m: (m[1], m[0], m[2]))
    ends = [m[1] for m in order]
    #: Per match its chains (first word, covered), by falling first word and rising cover.
    chains: list[list[tuple[int, int]]] = []
    for i, (start, end, place) in enumerate(order):
        found: dict[int, int] = {start: end - start}
        # Ends rise, so the predecessors are the matches just before this one.
        j = i - 1
        while j >= 0 and ends[j] >= start - max_gap:
            before, stop, other = order[j]
            skip = max(0, stop - start, other + stop - before - place)
            gain = end - start - skip
            if gain > 0:
                for first, covered in chains[j]:
                    if covered + gain > found.get(first, 0):
                        found[first] = covered + gain
            j -= 1
        kept: list[tuple[int, int]] = []
        for first in sorted(found, reverse=True):
            if not kept or found[first] > kept[-1][1]:
                kept.append((first, found[first]))
        chains.append(kept)
    return [(first, m[1], covered) for m, own in zip(order, chains) for first, covered in own]


def apart(chains: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those chains that together cover the most without overlapping in the text."""
    order = sorted(set(chains), key=lambda c: (c[1], -c[0], c[2]))
    ends = [c[1] for c in order]
    # Per number of chains looked at: the most they cover, and the last one taken.
    total, taken = [0], [-1]
    for i, (first, _, covered) in enumerate(order):
        with_it = total[bisect_right(ends, first, 0, i)] + covered
        total.append(max(total[i], with_it))
        taken.append(i if with_it > total[i] else taken[i])
    picked = []
    i = taken[-1]
    while i >= 0:
        picked.append(order[i])
        i = taken[bisect_right(ends, order[i][0], 0, i)]
    return picked[::-1]


SCAN_SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
    " base_labels string, labels string, score double,"
    " spans array<struct<label:string,first_word:bigint,end_word:bigint,cover:double>>"
)


def scanned(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    names: Mapping[str, str] | None = None,
    min_match: int = 3,
    max_gap: int = 8,
    min_cover: float = 0.8,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) its phrases, labels, best cover and template spans.

    ``score`` is the greatest share of a template, phrase or name that the text
    covers.  ``names`` (``licence_names()`` by default) label a text that holds
    them whole, the longest where several begin at a word, and are not counted
    as phrases.  ``spans`` are all stretches that cover ``min_cover`` of a
    template, none overlapping another of the same template.  A null or empty text has no words, no labels and score 0; first_word and
    last_word are null without a phrase.  Ids are passed on as they are, null and
    repeated ones too; an empty table gives no row.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = licence_names() if names is None else names
        scanner = LicenceScanner(templates, phrases, known, min_match, max_gap, min_cover)
        for batch in W.gathered(batches):
            yield _scan_chunk(scanner, batch)

    return docs.select("doc_id", "text").mapInArrow(scan, SCAN_SCHEMA)


def _scan_chunk(scanner: LicenceScanner, batch: pa.RecordBatch) -> pa.RecordBatch:
    text = W.words(batch.column(1), W.PLAIN)
    vocabulary = scanner.vocabulary
    number = np.fromiter(
        (vocabulary.get(w, -1) for w in text.dictionary.to_pylist()), np.int64, len(text.dictionary)
    )
    codes = number[text.codes] if len(number) else np.zeros(0, np.int64)
    phrases: dict[int, list] = {}
    names: dict[int, list] = {}
    matches: dict[int, list] = {}
    for doc, start, stop in known_runs(codes >= 0, text.first, scanner.shortest):
        scanner.scan(
            codes[start:stop].tolist(),
            start - int(text.first[doc]),
            phrases.setdefault(doc, []),
            names.setdefault(doc, []),
            matches.setdefault(doc, []),
        )
    count = batch.num_rows
    n_base = np.zeros(count, np.int64)
    first: list = [None] * count
    last: list = [None] * count
    base = [""] * count
    labels = [""] * count
    score = np.zeros(count)
    spans: list[list] = [[] for _ in range(count)]
    for doc in phrases:
        found = phrases[doc]
        score[doc], chains = scanner.chained(matches[doc])
        if found or names[doc]:
            score[doc] = 1.0
        if found:
            starts = [s for _, s in found]
            n_base[doc], first[doc], last[doc] = len(found), min(starts), max(starts)
        own = {scanner.phrase_labels[p] for p, _ in found}
        spans[doc] = [
            {"label": scanner.labels[t], "first_word": a, "end_word": b, "cover": s}
            for t, a, b, s in chains
        ]
        named = {scanner.name_labels[n] for n, _ in names[doc]}
        base[doc] = ",".join(sorted(own))
        labels[doc] = ",".join(sorted(own | named | {s["label"] for s in spans[doc]}))
    span_type = pa.list_(
        pa.struct(
            [
                ("label", pa.string()),
                ("first_word", pa.int64()),
                ("end_word", pa.int64()),
                ("cover", pa.float64()),
            ]
        )
    )
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array(text.lengths(), pa.int64()),
            pa.array(n_base),
            pa.array(first, pa.int64()),
            pa.array(last, pa.int64()),
            pa.array(base, pa.string()),
            pa.array(labels, pa.string()),
            pa.array(score),
            pa.array(spans, span_type),
        ],
        names=[
            "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
            "score", "spans",
        ],
    )


def known_runs(
    known: np.ndarray, first: np.ndarray, shortest: int
) -> Iterator[tuple[int, int, int]]:
    """(text, start, stop) of the runs of known words, within texts, of ``shortest`` and more."""
    padded = np.zeros(len(known) + 2, bool)
    padded[1:-1] = known
    # A run also ends where a text does.
    begins = padded[1:-1] & ~padded[:-2]
    heads = first[:-1][first[:-1] < len(known)]
    begins[heads] = known[heads]
    ends = np.append(begins[1:], False) | ~padded[2:]
    ends &= known
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = stop - start >= shortest
    start, stop = start[long], stop[long]
    owner = np.searchsorted(first, start, side="right") - 1
    yield from zip(owner.tolist(), start.tolist(), stop.tolist())
