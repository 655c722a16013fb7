"""Licence scan with a generalised suffix automaton of licence templates' words.

A text's words (A-Z lower-cased) stream through the automaton of all templates;
the matching statistic at a word is the longest suffix that is a substring of a
template.  Up the suffix links stand the shorter ones of further templates, so at
each word every template's longest match is known.  Where one cannot grow, it is
maximal; maximal matches of ``MIN_MATCH`` words or more are chained per template:
in order in both the text and the template, at most ``MAX_GAP`` words apart in
the text.  A template is met if its best chain covers ``NOTICE_COVER`` of it
(``BODY_COVER`` for those of over ``NOTICE_WORDS`` words) and its marks agree:
its own numbers and ``MARKS`` (words that part a licence from its kin) are
matched, and no other mark stands in the stretch of the text or next to it.  Of
met templates whose stretches overlap by half of the shorter the one with most
matched words wins, and gives its label.  The score is the best cover of the
winners, else of all templates.  Base phrases are templates too, and every place
where one ends is read off the automaton's states.

Only runs of words whose consecutive pairs all occur in a template are streamed
(found with numpy): elsewhere the statistic stays below two words.

Edge cases: null and empty texts have no words, no labels and score 0; every
input row gives one row, repeated rows too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_texts
from .words import ALNUM, Words, shingles

MIN_MATCH = 3
MAX_GAP = 12
NOTICE_WORDS, NOTICE_COVER, BODY_COVER = 20, 0.8, 0.7

# The base phrases, and licence notices and texts as published.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                 "in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
            "to this work."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License version 2 as published by the Free Software Foundation."),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License as published by the Free Software Foundation; either version 2 of the License, "
              "or (at your option) any later version."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License as published by the Free Software Foundation, either version 3 of the License, "
              "or (at your option) any later version."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
                 "the License, or (at your option) any later version."),
    ("lgpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
               "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
               "License, or (at your option) any later version."),
    ("agpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
               "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
               "License, or (at your option) any later version."),
    ("bsd-2", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
              "that the following conditions are met: Redistributions of source code must retain the above copyright "
              "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
              "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
              "documentation and/or other materials provided with the distribution."),
    ("bsd-3", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
              "that the following conditions are met: Redistributions of source code must retain the above copyright "
              "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
              "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
              "documentation and/or other materials provided with the distribution. Neither the name of the copyright "
              "holder nor the names of its contributors may be used to endorse or promote products derived from this "
              "software without specific prior written permission."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
             "use this software for any purpose, including commercial applications, and to alter it and redistribute "
             "it freely, subject to the following restrictions"),
    ("epl-1", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
              "License v1.0 which accompanies this distribution"),
    ("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
              "License 2.0 which accompanies this distribution"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
              "MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "Copyright. All rights reserved."),
)
# The public licences that share one notice, their names and versions.
COMMONS = {"cc-by": "Attribution", "cc-by-sa": "Attribution-ShareAlike", "cc-by-nd": "Attribution-NoDerivatives",
           "cc-by-nc": "Attribution-NonCommercial", "cc-by-nc-sa": "Attribution-NonCommercial-ShareAlike",
           "cc-by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
VERSIONS = ("4.0 International", "3.0 Unported", "2.5 Generic", "2.0 Generic")
TEMPLATES += tuple((label, f"This work is licensed under a Creative Commons {name} {version} License.")
                   for label, name in COMMONS.items() for version in VERSIONS)
TEMPLATES += tuple((label, f"Licensed under {label.upper().replace('-', ' ', 1)} {v.split()[0]}.") for label in COMMONS for v in VERSIONS)
# Words that part a licence from its kin.
MARKS = frozenset(b"noncommercial sharealike noderivatives noderivs nc sa nd lesser affero endorse".split())


def split(text: str) -> list[bytes]:
    w = Words([text.encode()], ALNUM)
    return [w.word(i) for i in range(w.n)]


class Automaton:
    """Suffix automaton of several word sequences; ``ends[s]`` lists (sequence, end) of state ``s``'s substrings."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        own: list[set[tuple[int, int]]] = [set()]
        for at, seq in enumerate(sequences):
            last = 0
            for i, c in enumerate(seq):
                last = self._extend(last, c, own)
                own[last].add((at, i + 1))
        for s in sorted(range(1, len(self.len)), key=lambda s: -self.len[s]):
            if self.link[s] > 0:
                own[self.link[s]] |= own[s]
        self.ends = [sorted(x) for x in own]

    def _state(self, length: int, own: list) -> int:
        self.next.append({})
        self.link.append(0)
        self.len.append(length)
        own.append(set())
        return len(self.len) - 1

    def _split(self, p: int, c: int, q: int, own: list) -> int:
        """The state for the longest substring that ``p`` extends by ``c``, parted from ``q`` if need be."""
        if self.len[q] == self.len[p] + 1:
            return q
        part = self._state(self.len[p] + 1, own)
        self.next[part], self.link[part] = dict(self.next[q]), self.link[q]
        self.link[q] = part
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = part
            p = self.link[p]
        return part

    def _extend(self, last: int, c: int, own: list) -> int:
        if c in self.next[last]:
            return self._split(last, c, self.next[last][c], own)
        new, p = self._state(self.len[last] + 1, own), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        self.link[new] = self._split(p, c, self.next[p][c], own) if p >= 0 else 0
        return new

    def walk(self, words: list[int]) -> list[tuple[int, int]]:
        """Matching statistics: (state, length) after each word."""
        out, state, length = [], 0, 0
        for c in words:
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.len[state]
            if c in self.next[state]:
                state, length = self.next[state][c], length + 1
            else:
                length = 0
            out.append((state, length))
        return out


class Scanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        texts = [split(p) for p in phrases.values()] + [split(t) for _, t in templates]
        self.labels = [*phrases, *(label for label, _ in templates)]
        self.n_phrases = len(phrases)
        self.texts, self.sizes = texts, [len(t) for t in texts]
        self.marks = [{w for w in t if w in MARKS or w.isdigit()} for t in texts]
        self.further: dict[int, dict[tuple[int, int], int]] = {}
        vocabulary = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        self.auto = Automaton([[vocabulary[w] for w in t] for t in texts])
        words = Words(list(vocabulary), ALNUM)
        order = np.argsort(words.hashes())
        self.keys, self.ids = words.hashes()[order], order
        self.vocabulary = list(vocabulary)
        pairs = [shingles(Words([b" ".join(t)], ALNUM).hashes(), 2) for t in texts]
        self.pairs = np.unique(np.concatenate(pairs))
        # per state: the phrases that end where the state's substrings end, and are suffixes of the longest
        self.phrase_ends: dict[int, list[int]] = {}
        for s, ends in enumerate(self.auto.ends):
            own = [t for t, e in ends if t < self.n_phrases and e == self.sizes[t] and self.sizes[t] <= self.auto.len[s]]
            if own:
                self.phrase_ends[s] = sorted(set(own))

    def runs(self, w: Words, h: np.ndarray):
        """(first word, word ids) of the runs to stream."""
        two = shingles(h, 2)
        if not len(two):
            return
        at = np.minimum(np.searchsorted(self.pairs, two), len(self.pairs) - 1)
        doc = w.doc()
        good = (self.pairs[at] == two) & (doc[1:] == doc[:-1])
        turns = np.flatnonzero(np.diff(np.concatenate(([0], good.view(np.int8), [0]))))
        for a, b in zip(turns[0::2].tolist(), turns[1::2].tolist()):
            if b - a + 1 >= MIN_MATCH:
                ids = self.ids[np.minimum(np.searchsorted(self.keys, h[a:b + 1]), len(self.keys) - 1)].tolist()
                yield a, [i if self.vocabulary[i] == w.word(a + j) else -1 for j, i in enumerate(ids)]

    def matches(self, w: Words):
        """Per text: (start word, length, template, its end there) of maximal matches, and (start word, phrase) of base phrases."""
        h = w.hashes()
        n = len(w.first) - 1
        found, base = [[] for _ in range(n)], [[] for _ in range(n)]
        for a, ids in self.runs(w, h):
            d = int(np.searchsorted(w.first, a, side="right") - 1)
            a -= int(w.first[d])
            stats, held = self.auto.walk(ids), {}
            for i, (state, length) in enumerate(stats):
                for t in self.phrase_ends.get(state, ()):
                    if self.sizes[t] <= length:
                        base[d].append((a + i + 1 - self.sizes[t], t))
                up = self.auto.link[state]
                while up > 0:  # phrases that end inside a longer match
                    for t in self.phrase_ends.get(up, ()):
                        if (a + i + 1 - self.sizes[t], t) not in base[d][-4:]:
                            base[d].append((a + i + 1 - self.sizes[t], t))
                    up = self.auto.link[up]
                now = self.longest(state, length) if length >= MIN_MATCH else {}
                found[d] += [(a + i - n, n, t, end) for (t, end), n in held.items() if (t, end + 1) not in now]
                held = now
            found[d] += [(a + len(stats) - n, n, t, end) for (t, end), n in held.items()]
        return found, base

    def longest(self, state: int, length: int) -> dict[tuple[int, int], int]:
        """The longest match of ``MIN_MATCH`` words or more that ends at each (template, end), given the statistic."""
        if state not in self.further:
            own, more, up = set(self.auto.ends[state]), {}, self.auto.link[state]
            while up > 0 and self.auto.len[up] >= MIN_MATCH:
                more |= {x: self.auto.len[up] for x in self.auto.ends[up] if x not in own and x not in more}
                up = self.auto.link[up]
            self.further[state] = more
        return dict.fromkeys(self.auto.ends[state], length) | self.further[state]

    def chain(self, matches: list) -> dict[int, tuple[int, tuple]]:
        """Each template's best chain: its matched words and its parts, (start, end) in the text and the template."""
        by: dict[int, list] = {}
        for start, length, t, end in matches:
            by.setdefault(t, []).append((start, start + length, end - length, end))
        out = {}
        for t, spans in by.items():
            spans.sort()
            best: list[tuple[int, int, int]] = []  # words, match before, words cut off at the begin
            for i, (a, b, p, q) in enumerate(spans):
                most = (q - p, -1, 0)
                for j in range(i - 1, -1, -1):
                    a2, b2, _, q2 = spans[j]
                    if a - a2 > self.sizes[t] + MAX_GAP:
                        break
                    cut = max(0, b2 - a, q2 - p)
                    if cut < q - p and a + cut - b2 <= MAX_GAP and best[j][0] + q - p - cut > most[0]:
                        most = (best[j][0] + q - p - cut, j, cut)
                best.append(most)
            i = max(range(len(best)), key=lambda i: best[i][0])
            words, parts = best[i][0], []
            while i >= 0:
                a, b, p, q = spans[i]
                _, i, cut = best[i]
                parts.append((a + cut, b, p + cut, q))
            out[t] = (words, tuple(reversed(parts)))
        return out

    def met(self, t: int, words: int, parts: tuple, word) -> bool:
        """Whether a chain covers enough of its template and the marks agree; ``word(i)`` is the text's word or None."""
        size = self.sizes[t]
        if words < size * (NOTICE_COVER if size <= NOTICE_WORDS else BODY_COVER):
            return False
        matched = {w for *_, p, q in parts for w in self.texts[t][p:q]}
        if not self.marks[t] <= matched:
            return False
        return all(w is None or w in self.marks[t] or w not in MARKS for w in map(word, range(parts[0][0] - 1, parts[-1][1] + 1)))

    def winners(self, chains: dict, word) -> list[tuple[str, int, int, float]]:
        """(label, first word, end, cover) of the met templates that no better one overlaps."""
        some = [(words, words / self.sizes[t], t, parts[0][0], parts[-1][1]) for t, (words, parts) in chains.items()
                if self.met(t, words, parts, word)]
        out: list[tuple[str, int, int, float]] = []
        for _, cover, t, a, b in sorted(some, key=lambda x: (-x[0], -x[1], x[2])):
            if not any(2 * (min(b, d) - max(a, c)) >= min(b - a, d - c) for _, c, d, _ in out):
                out.append((self.labels[t], a, b, cover))
        return sorted(out, key=lambda x: (x[1], x[2], x[0]))

    def scan(self, texts: list[bytes]) -> list[list]:
        """A column for each of ``FIELDS`` and ``SPANS``."""
        w = Words(texts, ALNUM)
        found, base = self.matches(w)
        out: list[list] = [[] for _ in range(8)]
        for d, n in enumerate(w.counts().tolist()):
            first = int(w.first[d])
            chains = self.chain(found[d])
            won = self.winners(chains, lambda i: w.word(first + i) if 0 <= i < n else None)
            places = set(base[d])
            starts = [s for s, _ in places]
            named = sorted({self.labels[t] for _, t in places})
            score = max([c for *_, c in won], default=max((m / self.sizes[t] for t, (m, _) in chains.items()), default=0.0))
            row = (n, len(places), min(starts, default=None), max(starts, default=None), ",".join(named),
                   ",".join(sorted({x[0] for x in won} | set(named))), min(1.0, score),
                   [{"label": x, "start": a, "end": b, "cover": c} for x, a, b, c in won])
            for column, value in zip(out, row):
                column.append(value)
        return out


FIELDS = [T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")] + [
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType())]


SPANS = T.StructField("license_spans", T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("cover", T.DoubleType())])))


def scan_licenses(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, templates=TEMPLATES,
                  phrases=PHRASES, spans: bool = False) -> DataFrame:
    """``keep`` columns (default all) of ``docs`` and the scan's ``FIELDS``; with ``spans`` also the winners' stretches
    (words from ``start`` to before ``end``) and covers."""
    sent = docs.sparkSession.sparkContext.broadcast(Scanner(templates, phrases))
    fields = [*FIELDS, SPANS] if spans else FIELDS

    def fn(texts: list[bytes], _: pa.RecordBatch):
        return sent.value.scan(texts)[:len(fields)]

    return map_texts(docs, fn, fields, text_col, keep)
