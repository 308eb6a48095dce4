"""Licence scans: matching statistics against a suffix automaton of licence templates, chained into spans.

The automaton holds every run of consecutive words of every template. A file's words stream through
it; at each word it knows the longest run ending there that occurs in some template. Runs that cannot
grow are anchors. Per template, anchors that go forward in the file and in the template are chained
over small gaps; a chain that covers enough of the template is a span and gives its label. Phrases
that must be found word for word are templates as well, read off the automaton at every word.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, table, whole_text

#: Share of a template's words that a chain must cover, and words that may be missing between anchors.
COVERED, GAP = 0.75, 8

# Phrases that count word for word, and their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Public licence notices and their labels.
TEMPLATES = (
    ("mit", "released under the MIT License"),
    ("mit", "licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2.0", "licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-2.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-4.0", "licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("warranty-disclaimer", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"),
)

_KEEP = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: digits, letters with A-Z lower-cased, everything beyond ASCII."""
    return text.translate(_KEEP).split()


@dataclass
class State:
    length: int
    link: int = -1
    step: dict[int, int] = field(default_factory=dict)
    ends: list[tuple[int, int]] = field(default_factory=list)     # (template, position of the last word) of its runs
    phrases: list[tuple[int, int]] = field(default_factory=list)  # (phrase, words) that end here if the run is long enough


class Scanner:
    """The automaton over templates and phrases, and the scan of one text."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, covered: float = COVERED, gap: int = GAP):
        self.covered, self.gap = covered, gap
        self.phrase_labels = [label for _, label in phrases]
        self.labels = [label for label, _ in templates]
        runs = [words_of(t.encode()) for _, t in templates] + [words_of(p.encode()) for p, _ in phrases]
        if not all(runs):
            raise ValueError("a template or phrase has no words")
        self.numbers: dict[bytes, int] = {}
        coded = [[self.numbers.setdefault(w, len(self.numbers)) for w in r] for r in runs]
        self.sizes = [len(r) for r in coded]
        self.states = [State(0)]
        own_ends: list[list[tuple[int, int]]] = [[]]
        for t, run in enumerate(coded):
            last = 0
            for p, w in enumerate(run):
                last = self._extend(last, w, own_ends)
                own_ends[last].append((t, p))
        n = len(self.numbers)
        self.pairs = np.zeros((n + 1, n + 1), dtype=bool)  # two words that stand together in a template; the last row and column are unknown words
        for run in coded:
            self.pairs[run[:-1], run[1:]] = True
        # a state's runs also end wherever a longer run of its sub-tree ends
        for s in sorted(range(1, len(self.states)), key=lambda s: -self.states[s].length):
            self.states[s].ends = sorted(set(own_ends[s]))
            if self.states[s].link > 0:
                own_ends[self.states[s].link] += own_ends[s]
        for k, run in enumerate(coded[len(templates):]):
            state = 0
            for w in run:
                state = self.states[state].step[w]
            self.states[state].phrases.append((k, len(run)))
        for s in sorted(range(1, len(self.states)), key=lambda s: self.states[s].length):
            self.states[s].phrases = self.states[s].phrases + self.states[self.states[s].link].phrases
        self.single: dict[int, list[int]] = defaultdict(list)
        for k, run in enumerate(coded[len(templates):]):
            if len(run) == 1:
                self.single[run[0]].append(k)

    def _extend(self, last: int, w: int, ends: list) -> int:
        """Adds word ``w`` after state ``last``; several templates share one automaton."""
        states = self.states
        if w in states[last].step:
            q = states[last].step[w]
            if states[q].length == states[last].length + 1:
                return q
            return self._split(last, q, w, ends)
        new = len(states)
        states.append(State(states[last].length + 1))
        ends.append([])
        p = last
        while p != -1 and w not in states[p].step:
            states[p].step[w] = new
            p = states[p].link
        if p == -1:
            states[new].link = 0
        else:
            q = states[p].step[w]
            states[new].link = q if states[q].length == states[p].length + 1 else self._split(p, q, w, ends)
        return new

    def _split(self, p: int, q: int, w: int, ends: list) -> int:
        states = self.states
        clone = len(states)
        states.append(State(states[p].length + 1, states[q].link, dict(states[q].step)))
        ends.append([])
        states[q].link = clone
        while p != -1 and states[p].step.get(w) == q:
            states[p].step[w] = clone
            p = states[p].link
        return clone

    def statistics(self, numbers: list[int]) -> list[tuple[int, int]]:
        """Matching statistics: for each word (state, length of the longest known run ending there)."""
        state, length, out = 0, 0, []
        for w in numbers:
            while state and w not in self.states[state].step:
                state = self.states[state].link
                length = self.states[state].length
            if w in self.states[state].step:
                state = self.states[state].step[w]
                length += 1
            else:
                state, length = 0, 0
            out.append((state, length))
        return out

    def _stretches(self, numbers: np.ndarray):
        """Starts and ends of stretches whose neighbouring words all stand together in some template.

        No run of two or more words reaches beyond its stretch, so the automaton need not see the rest.
        """
        good = self.pairs[numbers[:-1], numbers[1:]]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], good, [False]]).astype(np.int8)))
        return zip(edge[::2].tolist(), (edge[1::2] + 1).tolist())

    def scan(self, text: bytes) -> dict:
        """Words, places of the phrases (phrase, first word), spans (label, first, last word, covered share), score."""
        words = words_of(text)
        unknown = len(self.numbers)
        numbers = np.fromiter((self.numbers.get(w, unknown) for w in words), dtype=np.int64, count=len(words))
        places: list[tuple[int, int]] = []
        anchors: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        if self.single:
            places += [(k, i) for i, n in enumerate(numbers.tolist()) if n in self.single for k in self.single[n]]
        for first, end in self._stretches(numbers) if len(words) > 1 else ():
            found = self.statistics(numbers[first:end].tolist())
            for i, (state, length) in enumerate(found):
                for phrase, size in self.states[state].phrases:
                    if 1 < size <= length:
                        places.append((phrase, first + i - size + 1))
                if length > 1 and (i + 1 == len(found) or found[i + 1][1] <= length):  # it cannot grow
                    for template, last in self.states[state].ends:
                        anchors[template].append((first + i - length + 1, last - length + 1, length))
        spans, best = [], 0.0
        for template, own in anchors.items():
            if template >= len(self.labels):
                continue
            for start, last, covered in self._chains(own):
                share = covered / self.sizes[template]
                best = max(best, share)
                if share >= self.covered:
                    spans.append((self.labels[template], start, last, share))
        places.sort(key=lambda x: (x[1], x[0]))
        return {"n_words": len(words), "places": places, "spans": sorted(spans, key=lambda s: (s[1], s[2], s[0])), "score": 1.0 if places else min(1.0, best)}

    def _chains(self, anchors: list[tuple[int, int, int]]):
        """(first word, last word, covered words) of the chains of one template's anchors.

        Anchors are (first word in the file, in the template, words). One joins the open chain that
        ends before it in both, within the gap, and covers most; overlaps count once. A chain that the
        file has left behind is closed, so few are open at a time.
        """
        open_chains: list[list[int]] = []
        for at, inside, size in sorted(anchors):
            still = []
            for chain in open_chains:
                if at - chain[1] > self.gap + 1:
                    yield chain[0], chain[1], chain[3]
                else:
                    still.append(chain)
            open_chains = still
            joined = None
            for chain in open_chains:
                new_file, new_template = at + size - 1 - chain[1], inside + size - 1 - chain[2]
                gain = min(new_file, new_template, size)
                if gain > 0 and inside - chain[2] <= self.gap + 1 and abs(new_file - new_template) <= self.gap and (joined is None or chain[3] + gain > joined[0][3] + joined[1]):
                    joined = (chain, gain)
            if joined:
                chain, gain = joined
                open_chains.append([chain[0], at + size - 1, inside + size - 1, chain[3] + gain])
            if not joined or inside <= 1:
                open_chains.append([at, at + size - 1, inside + size - 1, size])
        for chain in open_chains:
            yield chain[0], chain[1], chain[3]


@lru_cache(maxsize=4)
def _scanner(templates, phrases, covered, gap) -> Scanner:
    return Scanner(templates, phrases, covered, gap)


def scan_licences(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, covered: float = COVERED, gap: int = GAP) -> DataFrame:
    """``doc_id, n_words, places, spans, score``, one row per input row, each judged by its text alone.

    ``places``: (label, word) of every occurrence of a phrase, words counted from 0. ``spans``: (label,
    first, last, covered) of templates covered to ``covered`` or more; the best chain of those that
    overlap with the same label. NULL and empty texts have no words, empty arrays and score 0.
    """
    place = pa.struct([("label", pa.string()), ("word", pa.int64())])
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.float64())])
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        scanner = _scanner(templates, phrases, covered, gap)
        for batch in sliced(batches):
            out = [scanner.scan(t.as_py()) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([r["n_words"] for r in out], pa.int64()),
                    pa.array([[{"label": scanner.phrase_labels[k], "word": w} for k, w in r["places"]] for r in out], pa.list_(place)),
                    pa.array([[dict(zip(("label", "first", "last", "covered"), s)) for s in _best(r["spans"])] for r in out], pa.list_(span)),
                    pa.array([r["score"] for r in out], pa.float64()),
                ],
                ["doc_id", "n_words", "places", "spans", "score"],
            )

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        run,
        f"doc_id {kind}, n_words long, places array<struct<label:string,word:long>>, "
        "spans array<struct<label:string,first:long,last:long,covered:double>>, score double",
    )


def _best(spans: list[tuple]) -> list[tuple]:
    """Of overlapping spans with one label the one that covers most (then the first)."""
    kept: list[tuple] = []
    taken: dict[str, list[tuple]] = defaultdict(list)
    for s in sorted(spans, key=lambda s: (-s[3], s[1], s[2])):
        if all(s[2] < k[1] or k[2] < s[1] for k in taken[s[0]]):
            taken[s[0]].append(s)
            kept.append(s)
    return sorted(kept, key=lambda s: (s[1], s[2], s[0]))


def op9_licence_scan(spark, sf_dir):
    found = scan_licences(table(spark, sf_dir, "documents"))
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    base, method = F.transform("places", lambda p: p["label"]), F.transform("spans", lambda s: s["label"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["word"])).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.concat(base, method)).alias("labels"),
        "score",
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["first"].cast("string"), s["last"].cast("string"))), ",").alias("template_spans"),
    )
