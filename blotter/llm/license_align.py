"""License scans: patience alignment of texts with license templates.

Texts and templates are words (runs of letters and digits, lower case). A
template is looked for around every occurrence of its keys, the template's
words that the fewest templates share (the longest of equals), one more than
may be lost: a notice that covers enough holds one of them. There, words that occur once in
the text's region and once in the template are anchors; the longest run of
anchors in the same order in both is kept (longest increasing subsequence), and
the gaps between them are aligned the same way. A gap without such words gives
the equal words at its two ends. Coverage is the share of the template's words
that are aligned; the span runs from the first to the last of them.

A template is left out for a text that lacks more of its distinct words than may be lost. Defined results: null and empty texts hold no license; of overlapping spans that cover
enough, the one with most aligned words is kept (ties: the earlier, then the template's name); repeated rows
repeat the result; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import map_docs

#: Share of a template's words that must be aligned, in percent.
COVER = 80
#: Words of a template that lead to it, at least.
KEYS = 3
#: Words that a region may be longer than its template, on either side, and by the template's length.
SLACK = 4
SLACK_SHARE = 0.25

#: Name and text of license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."
    ),
    "CC-BY": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC": "Licensed under CC BY-NC 4.0.",
    "GPL": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]
    keys: dict[str, tuple[int, ...]]  # and where each stands
    distinct: frozenset[str]
    lost: int  # words that a notice may lack

    @staticmethod
    def all(templates: dict[str, str], cover: int = COVER) -> list[Template]:
        made = {name: tuple(words_of(text)) for name, text in templates.items()}
        spread = Counter(w for words in made.values() for w in set(words))
        out = []
        for name, words in sorted(made.items()):
            if words:
                lost = len(words) - -(-cover * len(words) // 100)
                rare = sorted(set(words), key=lambda w: (w.isdigit(), spread[w], words.count(w), -len(w), w))[: max(KEYS, lost + 1)]
                keys = {k: tuple(i for i, w in enumerate(words) if w == k) for k in rare}
                out.append(Template(name, words, keys, frozenset(words), lost))
        return out


def increasing(places: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence, by patience piles."""
    tops: list[int] = []
    top_at: list[int] = []
    back = []
    for i, p in enumerate(places):
        k = bisect_left(tops, p)
        back.append(top_at[k - 1] if k else -1)
        tops[k : k + 1], top_at[k : k + 1] = [p], [i]
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: list[str], template: tuple[str, ...]) -> list[tuple[int, int]]:
    """Aligned (text, template) word positions, rising in both."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        at = {w: i for i, w in enumerate(template[c:d], c) if in_template[w] == 1 and in_text[w] == 1}
        anchors = [(i, at[w]) for i, w in enumerate(text[a:b], a) if w in at]
        kept = [anchors[k] for k in increasing([p for _, p in anchors])]
        out += kept
        if kept:
            edges = [(a - 1, c - 1), *kept, (b, d)]
            gaps += [(x + 1, y, u + 1, v) for (x, u), (y, v) in zip(edges, edges[1:])]
    return sorted(out)


class Scanner:
    def __init__(self, templates: dict[str, str], cover: int = COVER):
        self.templates, self.cover = Template.all(templates, cover), cover

    def find(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(name, coverage, start, end) of the licenses in a text, by start; code points, end exclusive."""
        words = [w.lower() for w in _WORD.findall(text or "")]
        held = set(words)
        found = []
        for t in self.templates:
            if len(t.distinct) - len(t.distinct & held) > t.lost:
                continue
            slack = SLACK + int(SLACK_SHARE * len(t.words))
            of_it = [0, *accumulate(w in t.distinct for w in words)]
            for i, w in enumerate(words):
                for place in t.keys.get(w, ()):
                    a, b = max(0, i - place - slack), min(len(words), max(0, i - place + len(t.words) + slack))
                    if len(t.words) - (of_it[b] - of_it[a]) > t.lost:
                        continue
                    pairs = align(words[a:b], t.words)
                    if 100 * len(pairs) >= self.cover * len(t.words):
                        found.append((-len(pairs), a + pairs[0][0], t.name, a + pairs[-1][0] + 1, len(pairs) / len(t.words)))
        if not found:
            return []
        spots = list(_WORD.finditer(text))
        out: list[tuple] = []
        for f in sorted(set(found)):
            if all(f[3] <= o[1] or f[1] >= o[3] for o in out):
                out.append(f)
        return sorted(((n, c, spots[a].start(), spots[b - 1].end()) for _, a, n, b, c in out), key=lambda x: x[2])


def licenses(docs: DataFrame, templates: dict[str, str] | None = None, cover: int = COVER, text_col: str = "text") -> DataFrame:
    """doc_id, license, coverage, start and end of every license notice found, without a shuffle."""
    chosen = TEMPLATES if templates is None else templates

    def rows(scanner, ids, texts):
        return {
            "x": [[{"license": n, "coverage": c, "start": a, "end": b} for n, c, a, b in scanner.find(t)] for t in texts]
        }

    kind = dict(docs.dtypes)["doc_id"]
    got = map_docs(
        docs,
        ["doc_id", text_col],
        rows,
        f"doc_id {kind}, x array<struct<license:string,coverage:double,start:bigint,end:bigint>>",
        lambda: Scanner(chosen, cover),
    )
    return got.select("doc_id", F.explode("x").alias("x")).select("doc_id", "x.license", "x.coverage", "x.start", "x.end")
