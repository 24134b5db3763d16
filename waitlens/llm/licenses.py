"""License scanning with a generalised suffix automaton of template words.

All templates go into one automaton. A text is streamed through it word by word, which gives
the matching statistics: at every word the longest run ending there that occurs in some
template. Where a run stops growing it is a seed; seeds of one template that lie in order
and close together chain into a span, whose coverage is the share of the template matched.
Short phrases that alone name a license are templates too, found at every place.

The automaton has a few thousand states and goes to every task; texts stay where they are
read. Words outside the templates, most of all, are skipped without entering it.

Results: null and empty texts have no words, no labels and score 0; repeated rows are
scanned alike; overlapping places all count; an empty table gives no rows; other columns
are ignored; a text of any length is streamed whole through the automaton.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import slices, utf8

# Phrases that name a license, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of public licenses and of the notices that point to them.
TEMPLATES = (
    ("mit", "released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software",
    ),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by", "licensed under CC BY 4.0"),
    ("reserved", "all rights reserved"),
)
#: Words of the shortest seed, of the widest gap between chained seeds, and of a template
#: that must be matched whole; longer ones count from this coverage on.
SEED, GAP, WHOLE, COVERAGE = 3, 8, 8, 0.7

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters, digits and anything beyond ASCII."""
    return text.translate(_FOLD).split()


class Automaton:
    """Suffix automaton of several word sequences, each started from the root again."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        #: (template, end) of occurrences of the state's longest string.
        self.ends: list[list[tuple[int, int]]] = [[]]

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(-1)
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        copy = self._state(self.length[at] + 1)
        self.next[copy] = dict(self.next[target])
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def add(self, template: int, words: Sequence[int]) -> None:
        last = 0
        for end, word in enumerate(words, 1):
            there = self.next[last].get(word)
            if there is not None:
                # Another template already spells this far.
                exact = self.length[there] == self.length[last] + 1
                last = there if exact else self._split(last, word, there)
            else:
                new = self._state(self.length[last] + 1)
                at = last
                while at >= 0 and word not in self.next[at]:
                    self.next[at][word] = new
                    at = self.link[at]
                if at < 0:
                    self.link[new] = 0
                else:
                    target = self.next[at][word]
                    exact = self.length[target] == self.length[at] + 1
                    self.link[new] = target if exact else self._split(at, word, target)
                last = new
            self.ends[last].append((template, end))

    def close(self) -> None:
        """Let every state know the occurrences of the longer ones it is a suffix of."""
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]].extend(self.ends[state])
        self.ends = [sorted(set(e)) for e in self.ends]

    def walk(self, words: Sequence[int]) -> Iterator[tuple[int, int]]:
        """Matching statistics: (state, length) after each word."""
        state, length = 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            else:
                length = 0
            yield state, length


class Scanner:
    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Mapping[str, str]):
        every = [(label, words_of(text.encode())) for label, text in templates]
        named = [(label, words_of(text.encode())) for text, label in phrases.items()]
        self.labels = [label for label, _ in every]
        self.sizes = [len(words) for _, words in every]
        self.vocabulary: dict[bytes, int] = {}
        number = lambda words: [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
        coded = [number(words) for _, words in every + named]
        self.automaton = Automaton()
        for i, sequence in enumerate(coded):
            self.automaton.add(i, sequence)
        self.automaton.close()
        # Which words follow one another in some template.
        self.follows = np.zeros((len(self.vocabulary) + 1,) * 2, bool)
        for sequence in coded:
            self.follows[sequence[:-1], sequence[1:]] = True
        # The state of a phrase, found by spelling it; longer strings that end in it hang below.
        self.phrases: dict[int, list[tuple[int, str]]] = defaultdict(list)
        for (label, words), sequence in zip(named, coded[len(every) :], strict=True):
            *_, (state, _) = self.automaton.walk(sequence)
            self.phrases[state].append((len(words), label))
        order = sorted(range(1, len(self.automaton.next)), key=lambda s: self.automaton.length[s])
        for state in order:
            above = self.phrases.get(self.automaton.link[state], [])
            if above:
                self.phrases[state] = sorted({*self.phrases.get(state, []), *above})

    def runs(self, words: list[bytes]) -> list[tuple[int, list[int]]]:
        """(place, word numbers) of the stretches whose every step occurs in some template."""
        if len(words) < 2:
            return []
        get, outside = self.vocabulary.get, len(self.vocabulary)
        ids = np.fromiter((get(w, outside) for w in words), np.int64, len(words))
        step = self.follows[ids[:-1], ids[1:]]
        if not step.any():
            return []
        edges = np.diff(np.r_[0, step.astype(np.int8), 0])
        starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        return [(int(a), ids[a : b + 1].tolist()) for a, b in zip(starts, stops, strict=True)]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], list[tuple]]:
        """(place, label) of all phrases; (first, last, label, coverage, enough) of chained spans."""
        places: list[tuple[int, str]] = []
        seeds: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for start, run in self.runs(words):
            before = (0, 0)
            for i, (state, length) in enumerate(self.automaton.walk(run)):
                for size, label in self.phrases.get(state, ()):
                    if size <= length:
                        places.append((start + i - size + 1, label))
                if before[1] >= SEED and length != before[1] + 1:
                    self._seed(seeds, start + i, *before)
                before = (state, length)
            if before[1] >= SEED:
                self._seed(seeds, start + len(run), *before)
        spans = []
        for template, found in seeds.items():
            spans += self._chain(template, found)
        return places, sorted(spans)

    def _seed(self, seeds: dict, stop: int, state: int, length: int) -> None:
        for template, end in self.automaton.ends[state]:
            if template < len(self.labels):
                seeds[template].append((stop - length, end - length, length))

    def _chain(self, template: int, found: list[tuple[int, int, int]]) -> list[tuple[int, int, str, float, bool]]:
        """Best chains of seeds in order in both text and template, and whether they suffice."""
        found = sorted(set(found))
        covered, since, first = [], [], []
        for i, (at, where, size) in enumerate(found):
            best, start, parent = size, at, -1
            for j in range(i - 1, -1, -1):
                a, w, s = found[j]
                if at - (a + s) > GAP + self.sizes[template]:
                    break
                if a + s <= at <= a + s + GAP and w + s <= where <= w + s + GAP and covered[j] + size > best:
                    best, start, parent = covered[j] + size, first[j], j
            covered.append(best)
            first.append(start)
            since.append(parent)
        used = {p for p in since if p >= 0}
        size = self.sizes[template]
        needed = 1.0 if size <= WHOLE else COVERAGE
        return [
            (first[i], at + n - 1, self.labels[template], covered[i] / size, covered[i] / size >= needed)
            for i, (at, _, n) in enumerate(found)
            if i not in used
        ]


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
) -> DataFrame:
    """Per document: n_words, places of phrases, spans of templates, labels and a score.

    The score is the best coverage of any template in the text; a phrase that names a
    license by itself scores 1.
    """
    places_type = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    spans_type = pa.list_(
        pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("coverage", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for batch in batches:
            for start, stop in slices(batch, 1):
                counts, places, spans, scores, labels = [], [], [], [], []
                for text in utf8(batch.column(1)[start:stop]):
                    words = words_of(text)
                    found, chained = scanner.scan(words)
                    kept = [s[:4] for s in chained if s[4]]
                    counts.append(len(words))
                    places.append([{"word": w, "label": k} for w, k in sorted(found)])
                    spans.append([dict(zip(("first", "last", "label", "coverage"), s, strict=True)) for s in kept])
                    scores.append(1.0 if found else max((s[3] for s in chained), default=0.0))
                    labels.append(sorted({k for _, k in found} | {s[2] for s in kept}))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[start:stop],
                        pa.array(counts, pa.int64()),
                        pa.array(places, places_type),
                        pa.array(spans, spans_type),
                        pa.array(labels, pa.list_(pa.string())),
                        pa.array(scores, pa.float64()),
                    ],
                    names=["doc_id", "n_words", "places", "spans", "labels", "score"],
                )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run,
        "doc_id long, n_words long, places array<struct<word:long,label:string>>, "
        "spans array<struct<first:long,last:long,label:string,coverage:double>>, labels array<string>, score double",
    )
