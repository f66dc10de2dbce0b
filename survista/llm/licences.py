"""Licence scan by matching statistics against a generalised suffix automaton of licence notices."""

from __future__ import annotations

from bisect import bisect_left
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from survista.llm.common import utf8

# The phrases and their labels that the task gives.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public licence notices by SPDX identifier, as their licensors word them.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
    ],
    "BSD-3-Clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "CC-BY-SA-4.0": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
        "software to the public domain worldwide. This software is distributed without any warranty.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
        "is available at https://www.eclipse.org/legal/epl-2.0/",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ],
}

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    """[0-9a-z] and non-ASCII runs after lower-casing A-Z."""
    return text.translate(_WORDS).split()


class Automaton:
    """Generalised suffix automaton of word sequences; each state knows where its words end in which sequence."""

    def __init__(self, texts: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [set()]
        for k, seq in enumerate(texts):
            last = 0
            for at, w in enumerate(seq):
                last = self._extend(last, w)
                self.ends[last].add((k, at))
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            self.ends[self.link[s]] |= self.ends[s]

    def _add(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(follow)
        self.ends.append(set())
        return len(self.link) - 1

    def _clone(self, p: int, w: int) -> int:
        """The state that p reaches by w, split off if it also stands for longer words."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        c = self._add(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._clone(last, w)
        s = self._add(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = s
            p = self.link[p]
        if p >= 0:
            self.link[s] = self._clone(p, w)
        return s

    def statistics(self, seq: list[int]):
        """(length, state) of the longest match that ends at each word."""
        s = n = 0
        for w in seq:
            while s and w not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            if w in self.next[s]:
                s, n = self.next[s][w], n + 1
            yield n, s


class Scanner:
    """Finds phrases and notices in texts."""

    def __init__(self, phrases: dict[str, str], notices: dict[str, list[str]], least: int = 3, gap: int = 12, share: float = 0.8):
        """``least``: words of a long match; ``gap``: words between two chained matches; ``share``: of a notice's words
        that a chain must cover."""
        self.least, self.gap, self.share = least, gap, share
        self.names = [(name, text) for name in sorted(notices) for text in notices[name]]
        split = [words(t.encode()) for _, t in self.names]
        self.phrases = [(words(p.encode()), label) for p, label in phrases.items()]
        self.ids: dict[bytes, int] = {}
        for w in (w for ws in [*split, *(p for p, _ in self.phrases)] for w in ws):
            self.ids.setdefault(w, len(self.ids))
        self.templates = [[self.ids[w] for w in ws] for ws in split]
        self.automaton = Automaton(self.templates)
        self.stops: dict[int, list[tuple[int, int, int, int]]] = {}
        self.wanted = [([self.ids[w] for w in p], label) for p, label in self.phrases]

    def scan(self, text: bytes):
        """n_words; places of phrases as (start, label); covered spans as (name, first word, last word, share covered)."""
        ws = words(text)
        ids = np.fromiter(map(self.ids.get, ws, repeat(-1)), np.int32, len(ws))
        places = []
        for p, label in self.wanted:
            at = np.flatnonzero(ids[:len(ids) - len(p) + 1] == p[0]) if len(ids) >= len(p) else []
            for k in range(1, len(p)):
                at = at[ids[at + k] == p[k]] if len(at) else at
            places += [(int(a), label) for a in at]
        # A long match lies in a run of known words: shorter runs hold none.
        known = np.concatenate(([False], ids >= 0, [False]))
        edges = np.flatnonzero(known[1:] != known[:-1])
        matches: dict[int, list] = {}
        for a, z in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if z - a >= self.least:
                self._long(ids[a:z].tolist(), a, matches)
        spans = [s for k in sorted(matches) for s in self._chains(k, matches[k])]
        return len(ws), sorted(places), spans

    def _long(self, seq: list[int], offset: int, out: dict[int, list]) -> None:
        """Matches of at least ``least`` words that the next word does not extend in their own template, by template: (start
        in the text, start in the template, words)."""
        for i, (n, s) in enumerate(self.automaton.statistics(seq)):
            if n >= self.least:
                after = seq[i + 1] if i + 1 < len(seq) else -1
                for k, end, m, follow in self._stops(s):
                    if follow != after or after < 0:
                        m = min(m, n)
                        out.setdefault(k, []).append((offset + i - m + 1, end - m + 1, m))

    def _stops(self, s: int) -> list[tuple[int, int, int, int]]:
        """Places where the words of state s, or shorter ends of them that are long enough, end: (template, last word in it,
        words, next word of the template or -1), each with its longest match."""
        if s not in self.stops:
            a, t, seen, found = self.automaton, s, set(), []
            while t > 0 and a.length[t] >= self.least:
                for k, end in a.ends[t] - seen:
                    found.append((k, end, a.length[t], self.templates[k][end + 1] if end + 1 < len(self.templates[k]) else -1))
                seen, t = a.ends[t], a.link[t]
            self.stops[s] = found
        return self.stops[s]

    def _chains(self, k: int, found: list):
        """Chains of matches, in order in text and template, that cover ``share`` of template k. Each match joins the chain
        that covers most; matches may overlap, words count once. Equal chains: the earlier."""
        size, chains = len(self.templates[k]), []
        found.sort()
        best: list[tuple[int, int, int]] = []  # covered, first word, previous match
        open_ = 0
        for i, (t, m, n) in enumerate(found):
            cover, first = n, t
            while open_ < i and found[open_][0] + size + self.gap * 2 < t:
                open_ += 1
            for j in range(open_, i):
                t0, m0, n0 = found[j]
                if t0 < t and m0 < m and m0 + n0 < m + n and t - (t0 + n0) <= self.gap:
                    new = best[j][0] + n - max(0, t0 + n0 - t, m0 + n0 - m)
                    if new > cover:
                        cover, first = new, best[j][1]
            best.append((cover, first, t + n - 1))
        taken: list[tuple[int, int]] = []  # spans given out, in order
        for cover, first, last in sorted(best, key=lambda b: (-b[0], b[1], b[2])):
            at = bisect_left(taken, (first, last))
            if (cover >= self.share * size and (at == 0 or taken[at - 1][1] < first) and (at == len(taken) or taken[at][0] > last)):
                taken.insert(at, (first, last))
                yield self.names[k][0], first, last, min(1.0, cover / size)


def scan(docs: DataFrame, phrases: dict | None = None, notices: dict | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    n_base counts the places of all phrases, first_word and last_word are their smallest and largest start (null without
    one). labels has the phrases' labels and the names of notices that a chain of long matches covers; score is the
    largest share of a notice covered by such a chain, else 0. spans lists (notice, first, last, share), words counted
    from 0. Null text counts as empty: no words, no labels. Rows with null or repeated ids are scanned like others; an
    empty table gives no rows.
    """
    spec = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scanner = Scanner(phrases or PHRASES, notices or NOTICES)
    span = pa.struct([("notice", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("share", pa.float64())])

    def found(batches):
        for b in batches:
            rows = []
            for text in utf8(b.column(1)):
                n, places, spans = scanner.scan(text)
                base = {label for _, label in places}
                rows.append({"n_words": n, "n_base": len(places), "first_word": places[0][0] if places else None,
                             "last_word": places[-1][0] if places else None, "base_labels": ",".join(sorted(base)),
                             "labels": ",".join(sorted(base | {s[0] for s in spans})), "score": max((s[3] for s in spans), default=0.0),
                             "spans": [dict(zip(("notice", "first", "last", "share"), s, strict=True)) for s in spans]})
            types = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                               ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])
            cols = pa.array(rows, types).flatten()
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["id", *[f.name for f in types]])

    kind = spec.schema["id"].dataType.simpleString()
    return spec.mapInArrow(found, f"id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
                           "labels string, score double, spans array<struct<notice:string,first:bigint,last:bigint,share:double>>"
                           ).withColumnRenamed("id", id_col)
