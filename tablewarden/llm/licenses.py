"""License scans with a generalised suffix automaton over the words of licence templates.

A text's words stream through the automaton, which keeps the longest template piece that ends at each word
(the matching statistics). A state and its suffix links name every template that the piece or an end of it stands
in, with all places there, so each template has its own longest match at a word. Long matches that follow each other
in the text and on one template are chained into spans. Where spans of several templates lie on the same words, the
one with more matched words holds; a template is reported if a span that holds covers enough of it. A base phrase
stands where the phrase's own state is an ancestor, by suffix links, of the state reached.

Nulls: a null text has no words and no labels, score 0. Very long texts stream: what is kept is the matches. Ties: of
spans with as many matched words the one that covers more of its template holds, then the first by name. Empty
tables give empty tables; repeated rows are scanned each for itself; other columns are ignored. Words over 0-9, A-Z,
a-z and all bytes from 0x80 on. doc_id is an integer.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_rows

# Phrases that are labels by themselves.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Opening or characteristic passages of public licences.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
}

#: Fewest consecutive words of a match that counts for a template; share of a template that its spans must cover; words skipped within a chain.
LONG, COVER, GAP = 4, 0.6, 6

_TABLE = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


class SuffixAutomaton:
    """Of several word sequences. ends[v]: (sequence, index of the last word) of every occurrence of v's words."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        prefixes = []
        for k, seq in enumerate(sequences):
            last = 0
            for i, w in enumerate(seq):
                last = self._append(last, w)
                prefixes.append((last, (k, i)))
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for v, end in prefixes:  # a state of one prefix stays so: clones take over shorter ones only
            self.ends[v].append(end)
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[v]] += self.ends[v]

    def _state(self, nxt: dict[int, int], link: int, length: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        clone = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _append(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new, p = self._state({}, 0, self.length[last] + 1), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def walk(self, seq: list[int]) -> int:
        v = 0
        for w in seq:
            v = self.next[v][w]
        return v


class Scanner:
    def __init__(self, base: dict[str, str], templates: dict[str, str]):
        self.names = [*templates]
        texts = [words(t) for t in (*templates.values(), *base)]
        self.vocab = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        seqs = [[self.vocab[w] for w in t] for t in texts]
        self.sizes = [len(s) for s in seqs[: len(self.names)]]
        self.sa = SuffixAutomaton(seqs)
        ends = {self.sa.walk(s): (label, len(s)) for s, label in zip(seqs[len(self.names) :], base.values(), strict=True)}
        self.phrases: list[tuple[tuple[int, str, int], ...]] = []  # of each state: (state, label, words) of the phrases that end there
        for v in range(len(self.sa.next)):
            found, u = [], v
            while u > 0:
                if u in ends:
                    found.append((u, *ends[u]))
                u = self.sa.link[u]
            self.phrases.append(tuple(found))
        #: Of each state: (template, words of its piece or 0 for all that is matched, places of the last word on it).
        self.pieces = [self._pieces(v) for v in range(len(self.sa.next))]

    def _pieces(self, v: int) -> list[tuple[int, int, list[int]]]:
        out, seen, u = [], set(), v
        while u > 0 and self.sa.length[u] >= LONG:
            for k in sorted({k for k, _ in self.sa.ends[u] if k < len(self.names)} - seen):
                seen.add(k)
                out.append((k, 0 if u == v else self.sa.length[u], sorted({e for j, e in self.sa.ends[u] if j == k})))
            u = self.sa.link[u]
        return out

    def statistics(self, ids: list[int | None]):
        """(word, state, length) of every word at which a template piece ends."""
        nxt, link, length = self.sa.next, self.sa.link, self.sa.length
        v = n = 0
        for i, w in enumerate(ids):
            if w is None:
                v = n = 0
                continue
            while v and w not in nxt[v]:
                v = link[v]
                n = length[v]
            if w in nxt[v]:
                v, n = nxt[v][w], n + 1
                yield i, v, n
            else:
                v = n = 0

    def scan(self, text: str):
        """n_words, base places [(start, label)], spans [(template, first word, last word, template words covered)], coverage by template."""
        ws = words(text)
        ids = list(map(self.vocab.get, ws))
        places: list[tuple[int, str]] = []
        open_: dict[int, tuple[int, int, list[int]]] = {}  # of each template: last word, words and places of the match that may go on
        chains: list[_Chain] = []
        if any(i is not None for i in ids):
            for i, v, n in self.statistics(ids):
                places += [(i - size + 1, label) for u, label, size in self.phrases[v] if n >= size]
                now = {k: (i, m or n, es) for k, m, es in self.pieces[v] if (m or n) >= LONG}
                for k, (j, m, es) in open_.items():
                    if k not in now or now[k][1] != m + 1 or j != i - 1:
                        self._chain(chains, k, j, m, es)
                open_ = now
            for k, (j, m, es) in open_.items():
                self._chain(chains, k, j, m, es)
        spans, cover = self._holding(c for c in chains if not c.extended)
        return len(ws), places, spans, cover

    def _chain(self, chains: list[_Chain], k: int, i: int, n: int, ends: list[int]) -> None:
        """Put the match of n words that ends at word i behind the best chain that it follows, at each of its places on template k."""
        recent = []
        for c in reversed(chains):
            if c.last < i - n - GAP:
                break
            if c.template == k:
                recent.append(c)
        for e in ends:
            best, gain = None, 0
            for c in recent:
                cut = max(0, c.end + n - e, c.last + n - i)  # what both have counts once
                if cut < n and e - n + cut - c.end <= GAP and i - n + cut - c.last <= GAP and c.matched + n - cut > gain:
                    best, gain = c, c.matched + n - cut
            if best:
                best.extended = True
            chains.append(_Chain(k, best.first if best else i - n + 1, i, e, gain or n))

    def _holding(self, found) -> tuple[list[tuple[str, int, int, int]], dict[str, float]]:
        """Spans in order of the text, and the largest share of each template; of spans on the same words (half of the shorter) one holds."""
        share = lambda c: c.matched / self.sizes[c.template]
        kept: list[_Chain] = []
        starts: list[int] = []  # first words of the kept spans, which lie apart but for less than half
        for c in sorted(found, key=lambda c: (-c.matched, -share(c), c.template, c.first)):
            at = bisect_left(starts, c.first)
            near = kept[max(0, at - 2) : at + 2]
            if all(2 * (min(c.last, d.last) - max(c.first, d.first) + 1) <= c.last - c.first + 1 for d in near):
                starts.insert(at, c.first)
                kept.insert(at, c)
        cover: dict[str, float] = {}
        for c in kept:
            name = self.names[c.template]
            cover[name] = max(cover.get(name, 0.0), share(c))
        return [(self.names[c.template], c.first, c.last, c.matched) for c in kept], cover


@dataclass
class _Chain:
    template: int
    first: int
    last: int
    end: int
    matched: int
    extended: bool = False


@lru_cache(4)
def scanner_of(base: tuple[tuple[str, str], ...], templates: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(dict(base), dict(templates))


SPANS = pa.list_(pa.struct([("template", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("matched_words", pa.int64())]))


def scan_licenses(df: DataFrame, base: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans of every row.

    score: 1 with a base label, else the largest share of a template that one span covers. base: phrase -> label;
    templates: name -> text; those of this module if not given.
    """
    known = tuple((BASE if base is None else base).items()), tuple((TEMPLATES if templates is None else templates).items())
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", SPANS)])

    def make():
        s = scanner_of(*known)

        def step(c):
            rows = []
            for key, text in zip(c["doc_id"], c["text"], strict=True):
                n, places, spans, cover = s.scan(text or "")
                base = {x for _, x in places}
                named = base | {k for k, x in cover.items() if x >= COVER}
                starts = [x for x, _ in places]
                rows.append((key, n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(named)), 1.0 if base else min(1.0, max(cover.values(), default=0.0)), [dict(zip(("template", "first_word", "last_word", "matched_words"), x, strict=True)) for x in spans]))
            return dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True))

        return step

    return map_rows(df.select("doc_id", "text"), make, schema)
