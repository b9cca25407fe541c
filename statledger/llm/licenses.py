"""Licence scan of documents by a generalised suffix automaton over licence words.

Method. Templates (licence notices and short phrases) are cut into words and built into one generalised suffix automaton. A document is streamed
through it once and gives matching statistics: at each word, the longest run that ends there and stands in a template. Runs that can't be
extended and hold ``LEAST`` words or more are long matches. For each template, long matches are chained where they keep its order, with at most
``GAP`` other words between them; the best chain ends in a span of the document that covers so many words of the template. A template gives its
label if a chain covers ``COVER`` of it and ``SOME`` words, or ``MANY`` words. A phrase stands wherever the statistics hold it in full.

Words are runs of bytes that are ASCII letters, digits or beyond ASCII, A-Z lower-cased. Only runs of words whose neighbouring pairs all stand in
a template are streamed: elsewhere a match is one word long.

Defined results. Each row gives one row, repeated ids and rows too; null and empty texts have no words, labels '' and score 0. Long texts are
read in whole, in pieces. The score is the largest share of a template that one chain covers, 1 where a phrase stands. Ties of chains show the
first one. Overlapping places of phrases all count. Empty tables give no rows. Other columns are not looked at.

At scale. One pass without a shuffle; the automaton is built in each task from the templates, which are small and sent with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches
from .words import NO_WORD, hashes, slices

LEAST, GAP, COVER, SOME, MANY = 4, 12, 0.5, 8, 20

#: Phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
#: Public licence notices and their labels.
TEMPLATES = (
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may "
     "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
     "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
     "implied. See the License for the specific language governing permissions and limitations under the License.", "apache"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
     "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
     "Software.", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
     "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
     "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
     "documentation and/or other materials provided with the distribution.", "bsd"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
     "Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope "
     "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
     "See the GNU General Public License for more details.", "gpl"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
     "by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "lgpl"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
     "You can obtain one at https://mozilla.org/MPL/2.0/.", "mpl"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
     "copyright notice and this permission notice appear in all copies.", "isc"),
    ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
     "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
     "unlicense"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
)
_SCAN = ("n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, "
         "spans array<struct<label: string, first_word: long, end_word: long, covered: long, cover: double>>")


class Automaton:
    """Generalised suffix automaton of word sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for words in sequences:
            last = 0
            for word in words:
                last = self._extended(last, word)
        #: (sequence, end) of every place where the longest run of a state stands.
        self.places: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for s, words in enumerate(sequences):
            state = 0
            for end, word in enumerate(words, 1):
                state = self.next[state][word]
                self.places[state].append((s, end))
        for state in sorted(range(1, len(self.next)), key=lambda v: -self.length[v]):
            if self.link[state] > 0:
                self.places[self.link[state]] += self.places[state]

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, before: int, word: int) -> int:
        """The state that ``word`` leads to from ``before``, cut so that its longest run is just one word longer."""
        old = self.next[before][word]
        if self.length[old] == self.length[before] + 1:
            return old
        new = self._state(self.length[before] + 1, dict(self.next[old]), self.link[old])
        self.link[old] = new
        while before >= 0 and self.next[before].get(word) == old:
            self.next[before][word] = new
            before = self.link[before]
        return new

    def _extended(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        state = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, word)
        return state

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest run that ends at each word."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            else:
                state = length = 0
            yield state, length


def chained(matches: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """Covered words, first word and end of the best chain of matches (end in the document, end in the template, length).

    Matches are ordered by their end in the document; of one that overlaps the one before it only the new part counts.
    """
    best = (0, 0, 0)
    chains: list[tuple[int, int, int, int]] = []  # ends in document and template, covered words, first word
    for end, to, length in matches:
        covered, first = length, end - length
        for old_end, old_to, old_covered, old_first in reversed(chains):
            if old_end < end - length - GAP:
                break
            new = min(length, end - old_end, to - old_to)
            if new > 0 and to - old_to - new <= GAP and old_covered + new > covered:
                covered, first = old_covered + new, old_first
        chains.append((end, to, covered, first))
        if covered > best[0]:
            best = (covered, first, end)
    return best


class Scanner:
    """Templates and phrases, ready to scan slices of documents."""

    def __init__(self, templates, phrases):
        texts = [*(t for t, _ in phrases), *(t for t, _ in templates)]
        found = []
        for _, raw, offsets in slices(pa.array(texts, pa.large_string())):
            words, first = hashes(raw, offsets, NO_WORD)
            found += [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        self.phrases, self.templates = [label for _, label in phrases], [label for _, label in templates]
        if any(len(w) < 2 for w in found):
            raise ValueError("templates and phrases need two words at least")
        self.vocabulary = np.unique(np.concatenate(found)) if found else np.zeros(1, np.uint64)
        self.some = np.zeros(1 << 16, bool)
        self.some[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True
        own = [np.searchsorted(self.vocabulary, w).tolist() for w in found]
        self.sizes = [len(w) for w in own]
        self.automaton = Automaton(own)
        size = len(self.vocabulary)
        #: 1 for neighbouring words of a template, 2 for those of a phrase.
        self.pairs = np.zeros((size, size), np.uint8)
        for k, words in reversed(list(enumerate(own))):
            self.pairs[words[:-1], words[1:]] = 2 if k < len(phrases) else 1
        #: Phrases that the runs of a state end with, where they are long enough.
        self.ending: list[list[int]] = [[] for _ in self.automaton.next]
        for s in range(len(phrases)):
            self.ending[self._state(own[s])].append(s)
        for state in sorted(range(1, len(self.ending)), key=lambda v: self.automaton.length[v]):
            self.ending[state] = self.ending[self.automaton.link[state]] + self.ending[state]

    def _state(self, words: list[int]) -> int:
        state = 0
        for word in words:
            state = self.automaton.next[state][word]
        return state

    def scan(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[list[tuple[int, int]], list[tuple]]]]:
        """Number of words of each row; for rows with any, the (word, phrase) places and the spans of templates."""
        words, first = hashes(raw, offsets, NO_WORD)
        counts = np.diff(first)
        at = np.flatnonzero(self.some[(words >> np.uint64(48)).astype(np.int64)])
        term = np.minimum(np.searchsorted(self.vocabulary, words[at]), len(self.vocabulary) - 1)
        same = self.vocabulary[term] == words[at]
        at, term = at[same], term[same]
        row = np.searchsorted(first, at, "right") - 1
        if len(at) < 2:
            return counts, {}
        kind = np.where((np.diff(at) == 1) & (np.diff(row) == 0), self.pairs[term[:-1], term[1:]], 0)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], kind > 0, [0]))))
        starts, ends = edge[::2], edge[1::2]  # of pairs
        phrase = np.concatenate(([0], np.cumsum(kind == 2)))
        keep = (ends - starts + 1 >= LEAST) | (phrase[ends] > phrase[starts])
        places: dict[int, list] = {}
        matches: dict[int, dict[int, list]] = {}
        for a, b in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True):
            r = int(row[a])
            self._stream(term[a : b + 1].tolist(), int(at[a] - first[r]), places.setdefault(r, []), matches.setdefault(r, {}))
        found = {}
        for r, each in matches.items():
            spans = []
            for s, own in each.items():
                covered, begin, end = chained(own)
                spans.append((self.templates[s - len(self.phrases)], begin, end, covered, min(1.0, covered / self.sizes[s])))
            found[r] = places[r], sorted(spans, key=lambda x: (x[1], x[2], x[0], x[3]))
        return counts, found

    def _stream(self, terms: list[int], begin: int, places: list, matches: dict[int, list]) -> None:
        before, was = 0, 0
        for end, (state, length) in enumerate(self.automaton.statistics(terms), begin + 1):
            if was >= LEAST and length <= was:
                self._matched(before, was, end - 1, matches)
            for s in self.ending[state]:
                if length >= self.sizes[s]:
                    places.append((end - self.sizes[s], s))
            before, was = state, length
        if was >= LEAST:
            self._matched(before, was, begin + len(terms), matches)

    def _matched(self, state: int, length: int, end: int, matches: dict[int, list]) -> None:
        for s, to in self.automaton.places[state]:
            if s >= len(self.phrases):
                matches.setdefault(s, []).append((end, to, length))


def accepted(span: tuple) -> bool:
    """Whether a span gives its label."""
    return span[3] >= MANY or span[3] >= SOME and span[4] >= COVER


def _scanning(templates, phrases):
    def run(batches):
        scanner = Scanner(templates, phrases)
        for batch in batches:
            out = []
            for _, raw, offsets in slices(batch.column(1)):
                counts, found = scanner.scan(raw, offsets)
                for r, n in enumerate(counts.tolist()):
                    places, spans = found.get(r, ((), ()))
                    base = {scanner.phrases[s] for _, s in places}
                    labels = base | {x[0] for x in spans if accepted(x)}
                    score = 1.0 if places else max((x[4] for x in spans), default=0.0)
                    out.append((n, len(places), min(places)[0] if places else None, max(places)[0] if places else None, sorted(base), sorted(labels), score,
                                [dict(zip(("label", "first_word", "end_word", "covered", "cover"), x, strict=True)) for x in spans]))
            names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
            long, texts = pa.int64(), pa.list_(pa.string())
            span = pa.struct([("label", pa.string()), ("first_word", long), ("end_word", long), ("covered", long), ("cover", pa.float64())])
            types = (long, long, long, long, texts, texts, pa.float64(), pa.list_(span))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([x[i] for x in out], t) for i, t in enumerate(types))], names=["doc_id", *names])

    return run


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """doc_id, n_words, phrase places (n_base, first_word, last_word, base_labels), labels, score and template spans of every row."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _scanning(tuple(templates), tuple(phrases)), f"doc_id {kind}, {_SCAN}")


def scanned(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """``license_scan`` with labels and spans as text: label:first word:end:covered words."""
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["first_word"], s["end_word"], s["covered"]))
    return license_scan(docs, templates, phrases).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score", F.array_join(spans, ",").alias("spans"))
