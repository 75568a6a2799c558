"""Licence scan: a generalised suffix automaton of licence tokens, streamed over files.

``Automaton`` holds every run of tokens of all templates. ``scan`` streams a
file's tokens through it: at each token the length of the longest run that ends
there and stands in a template (the matching statistics), and by the suffix links
the longest run of every other place of a template that ends there. Runs that are
long enough and that their own template doesn't extend are chained, in template
order, into spans; a span that covers enough of its template gives the template's
label, also where another template goes on.

Defined results: null and empty texts have no words, labels are "" and the
score is 0; null ids and repeated rows give a row each.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import FOLD, add_columns, utf8

# Phrases and labels that are counted wherever they stand.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Licence notices and the parts of licences that files quote.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following"),
    ("0bsd", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS"),
]


def words_of(text: bytes | None) -> list[bytes]:
    """Whole text's words: A-Z lower-cased, split at ASCII non-alphanumerics."""
    return text.translate(FOLD).split() if text else []


class Automaton:
    """Generalised suffix automaton over token sequences.

    ``step`` maps (state, token) to a state, ``link`` is the suffix link and
    ``length`` the longest run of a state; ``ends`` lists where its runs end, as
    (template, tokens up to there).
    """

    def __init__(self, sequences: list[list]):
        self.sequences = sequences
        self.step: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        for tokens in sequences:
            last = 0
            for t in tokens:
                last = self._extend(last, t)
        self.ends: list[set[tuple[int, int]]] = [set() for _ in self.step]
        for n, tokens in enumerate(sequences):
            state = 0
            for i, t in enumerate(tokens):
                state = self.step[state][t]
                self.ends[state].add((n, i + 1))
        for s in sorted(range(1, len(self.step)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                self.ends[self.link[s]] |= self.ends[s]

    def _state(self, length: int, step: dict, link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.step) - 1

    def _split(self, p: int, t, q: int) -> int:
        """The part of ``q`` whose runs are at most one token longer than ``p``'s."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.step[p].get(t) == q:
            self.step[p][t] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, t) -> int:
        if t in self.step[last]:
            return self._split(last, t, self.step[last][t])
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and t not in self.step[p]:
            self.step[p][t] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, t, self.step[p][t])
        return new

    def longest(self, tokens: list, least: int) -> Iterator[tuple[int, int, int]]:
        """Per token the longest run that ends there, if it has ``least`` tokens: (end, length, state)."""
        state, n = 0, 0
        step, link, length = self.step, self.link, self.length
        root = step[0]
        for i, t in enumerate(tokens):
            to = step[state].get(t) if state else root.get(t)
            if to is None:
                while state and t not in step[state]:
                    state = link[state]
                    n = length[state]
                to = step[state].get(t)
            state, n = (to, n + 1) if to is not None else (0, 0)
            if n >= least:
                yield i + 1, n, state

    def matches(self, tokens: list, least: int) -> list[tuple[int, int, int]]:
        """Runs of at least ``least`` tokens that no template extends: (end, length, state)."""
        out = list(self.longest(tokens, least))
        return [a for a, b in zip(out, [*out[1:], (0, 0, 0)]) if (a[0] + 1, a[1] + 1) != b[:2]]

    def runs(self, tokens: list, least: int) -> list[tuple[int, int, int, int]]:
        """Runs of at least ``least`` tokens that their own template doesn't extend: (end, length, template, tokens up to there)."""
        out = []
        for end, n, state in self.longest(tokens, least):
            after, known = tokens[end:end + 1], set()
            while n >= least:  # a suffix link's ends hold the state's own
                for template, at in self.ends[state] - known:
                    own = self.sequences[template][at:at + 1]
                    if not own or own != after:
                        out.append((end, n, template, at))
                known, state = self.ends[state], self.link[state]
                n = self.length[state]
        return out


def chain(found: list[tuple[int, int, int]], tokens_of: int, max_gap: int) -> list[tuple[int, int, int]]:
    """Chains of runs (end in file, length, end in template): (first word, end, covered tokens).

    Runs follow each other in file and template order with at most ``max_gap``
    file words between; overlaps count once. One span per chain, best first.
    """
    found = sorted(found)
    best: list[tuple[int, int]] = []  # covered tokens, start in the file
    follows: set[int] = set()
    ends = [end for end, _, _ in found]
    for j, (end, n, at) in enumerate(found):
        cover, start, before = n, end - n, -1
        for i in range(bisect_left(ends, end - n - max_gap), j):
            pend, _, pat = found[i]
            if pend < end and pat < at:
                new = min(n, end - pend, at - pat)
                if best[i][0] + new > cover and end - n - pend <= max_gap:
                    cover, start, before = best[i][0] + new, best[i][1], i
        if before >= 0:
            follows.add(before)
        best.append((min(cover, tokens_of), start))
    return [(s, found[j][0], c) for j, (c, s) in enumerate(best) if j not in follows]


class Scanner:
    """Templates with their automaton; ``scan`` gives a file's spans."""

    def __init__(self, templates=TEMPLATES, least: int = 4, min_cover: float = 0.75, max_gap: int = 12):
        self.templates = [(label, words_of(text.encode())) for label, text in templates]
        self.least, self.min_cover, self.max_gap = least, min_cover, max_gap
        self.automaton = Automaton([w for _, w in self.templates])

    def scan(self, words: list[bytes]) -> tuple[list[tuple[str, int, int, float]], float]:
        """Spans (label, first word, end, share of the template) and the best share of any template."""
        by_template = defaultdict(list)
        for end, n, template, at in self.automaton.runs(words, self.least):
            by_template[template].append((end, n, at))
        spans, best = [], 0.0
        for template, found in sorted(by_template.items()):
            label, tokens = self.templates[template]
            for start, end, cover in chain(found, len(tokens), self.max_gap):
                share = cover / len(tokens)
                best = max(best, share)
                if share >= self.min_cover:
                    spans.append((label, start, end, share))
        return sorted(spans, key=lambda s: (s[1], s[2], s[0])), best


@lru_cache(maxsize=2)
def _scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    """One scanner a Python worker, however many tasks it runs."""
    return Scanner(templates)


def templates_of(licences: DataFrame, max_chars: int = 4_000_000) -> tuple[tuple[str, str], ...]:
    """The templates of a table (label, text), such as whole licences, for ``scan_documents``.

    Rows with a null label or a text without words are none, repeated rows are one.
    Templates go to every task as a whole; more than ``max_chars`` characters raise.
    """
    rows = licences.where(F.col("label").isNotNull() & F.col("text").isNotNull()).select("label", "text").distinct()
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    if size > max_chars:
        raise ValueError(f"{size} characters of templates, more than {max_chars}")
    return tuple(sorted((r.label, r.text) for r in rows.collect() if words_of(r.text.encode())))


def templates_in(spark, path: str, max_chars: int = 4_000_000) -> tuple[tuple[str, str], ...]:
    """The templates of a folder of text files, each a whole licence; the file's name in lower case is the label."""
    files = spark.read.text(path, wholetext=True)
    return templates_of(files.select(F.lower(F.regexp_extract("_metadata.file_path", "([^/]+)$", 1)).alias("label"),
                                     F.col("value").alias("text")), max_chars)


def phrase_places(words: list[bytes], phrases: dict[str, str] = PHRASES) -> dict[str, list[int]]:
    """Word positions at which each phrase starts, overlapping ones too."""
    out = {}
    line = b" %b " % b" ".join(words)
    for phrase, label in phrases.items():
        probe, at, word, seen = b" %b " % phrase.encode(), 0, 0, 0
        places = []
        while (at := line.find(probe, at)) >= 0:
            word += line.count(b" ", seen, at)
            seen = at
            places.append(word)
            at += 1
        if places:
            out.setdefault(label, []).extend(places)
    return out


SPAN = T.StructType([T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()),
                     T.StructField("end_word", T.LongType()), T.StructField("coverage", T.DoubleType())])
FIELDS = [("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()),
          ("last_word", T.LongType()), ("base_labels", T.StringType()), ("labels", T.StringType()),
          ("score", T.DoubleType()), ("spans", T.ArrayType(SPAN))]


def _scan_texts(templates):
    scanner = _scanner(templates)

    def one(text):
        words = words_of(text)
        places = phrase_places(words)
        spans, score = scanner.scan(words)
        flat = sorted(p for v in places.values() for p in v)
        labels = sorted({*places, *(s[0] for s in spans)})
        return (len(words), len(flat), flat[0] if flat else None, flat[-1] if flat else None,
                ",".join(sorted(places)), ",".join(labels), score,
                [dict(zip(SPAN.names, s)) for s in spans])

    return lambda texts: list(zip(*map(one, utf8(texts)))) or [[] for _ in FIELDS]


def scan_documents(docs: DataFrame, text_col: str = "text", templates: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """``docs`` with the columns of ``FIELDS``; columns of these names are replaced.

    ``templates`` (label, text) are held beside the built-in notices.
    """
    held = (*TEMPLATES, *(t for t in templates if t not in TEMPLATES))
    return add_columns(docs, [text_col], FIELDS, lambda: _scan_texts(held))


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence phrases, labels and score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_documents(docs).drop("text", "spans")
