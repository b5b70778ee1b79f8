"""License texts in documents, found by patience alignment against templates.

Words that occur once in both a stretch of text and the template anchor the alignment; of the anchors the longest increasing
subsequence stands, and the gaps between them are aligned the same way, after common words at their ends. Coverage is the
share of the template's words that found a partner.

Only stretches around a template's key words are aligned. Key words are chosen so that a text without any of them
cannot reach the wished coverage, so nothing is missed by looking there; how far a stretch reaches beyond the template
bounds how many foreign words may stand in between.

Defined results: null and empty texts match nothing; each match of a template in a text is a row, overlapping matches of one
template give the best one, the first of equals; a match must hold the words that name the license and its version; repeated rows give repeated matches; null ids are kept. Only
the id and text columns are read, so others cannot clash.
"""

import bisect
import re
from collections import Counter

import pyarrow as pa

from hubbub.llm.shared import slices, with_nulls_as_text

COVERAGE = 0.8
WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")

# Notices as their publishers word them.
TEMPLATES = {
    "Apache-2.0 reference": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT reference": "Released under the MIT License.",
    "MIT notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "BSD notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL-3.0 reference": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0 reference": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 reference": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 reference": "Licensed under CC BY-NC 4.0.",
    "GPL-2.0 notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1 notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}

# What names a license: runs of words that a match must hold, word by word and with nothing in between.
IDENTIFYING = {
    "Apache-2.0 reference": ["apache license", "2.0"],
    "Apache-2.0 notice": ["apache license", "2.0"],
    "MIT reference": ["mit"],
    "GPL-3.0 reference": ["gnu general public license", "version 3"],
    "GPL-3.0 notice": ["gnu general public license", "version 3"],
    "GPL-2.0 notice": ["gnu general public license", "version 2"],
    "LGPL-2.1 notice": ["gnu lesser general public license", "version 2.1"],
    "LGPL-3.0 notice": ["gnu lesser general public license", "version 3"],
    "AGPL-3.0 notice": ["gnu affero general public license", "version 3"],
    "MPL-2.0 notice": ["mozilla public license", "2.0"],
    "CC-BY-4.0 reference": ["cc by 4.0"],
    "CC-BY-SA-4.0 reference": ["cc by-sa 4.0"],
    "CC-BY-NC-4.0 reference": ["cc by-nc 4.0"],
}


def words_of(text):
    """Lower-cased words with their places."""
    found = [(m[0].lower(), m.start(), m.end()) for m in WORD.finditer(text)]
    return [f[0] for f in found], found


def increasing(values):
    """Indexes of a longest increasing subsequence: piles as in the card game, with links back."""
    tops, piles, back = [], [], [None] * len(values)
    for i, v in enumerate(values):
        at = bisect.bisect_left(tops, v)
        back[i] = piles[at - 1] if at else None
        if at == len(tops):
            tops.append(v), piles.append(i)
        else:
            tops[at], piles[at] = v, i
    out, at = [], piles[-1] if piles else None
    while at is not None:
        out.append(at)
        at = back[at]
    return out[::-1]


def align(template, text):
    """Pairs of places (in template, in text), both rising, by patience alignment."""
    pairs, todo = [], [(0, len(template), 0, len(text))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and template[a] == text[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a == b or c == d:
            continue
        mine, theirs = Counter(template[a:b]), Counter(text[c:d])
        place = {w: j for j, w in enumerate(text[c:d], c) if theirs[w] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(template[a:b], a) if mine[w] == 1 and w in place]
        chosen = [anchors[k] for k in increasing([j for _, j in anchors])]
        if not chosen:
            continue
        pairs += chosen
        edges = [(a - 1, c - 1), *chosen, (b, d)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(pairs)


class Template:
    def __init__(self, name, text, coverage, common):
        self.name, (self.words, _) = name, words_of(text)
        self.slack = max(2, len(self.words) // 5)
        self.needed = coverage * len(self.words)
        # Places of the words that must match; those of one run follow each other.
        self.must = []
        for run in IDENTIFYING.get(name, ()):
            run = run.split()
            at = next(i for i in range(len(self.words)) if self.words[i:i + len(run)] == run)
            self.must.append(range(at, at + len(run)))
        # The rarest and longest words, until leaving all of them out leaves too little.
        self.keys, left, own = {}, len(self.words), Counter(self.words)
        for w in sorted(own, key=lambda w: (common[w], -len(w), w)):
            if left < self.needed:
                break
            self.keys[w] = [i for i, x in enumerate(self.words) if x == w]
            left -= own[w]

    def named(self, pairs):
        """Whether all identifying words have partners, which follow each other within a run."""
        place = dict(pairs) if self.must else {}
        return all(all(i in place and place[i] - i == place.get(run[0], 0) - run[0] for i in run) for run in self.must)

    def matches(self, words, places_of):
        """(coverage, first word, last word) of non-overlapping matches, the best first among overlapping ones."""
        tried, found = set(), []
        for key, spots in self.keys.items():
            for p in places_of.get(key, ()):
                for t in spots:
                    if p - t in tried:
                        continue
                    tried.add(p - t)
                    begin = max(0, p - t - self.slack)
                    pairs = align(self.words, words[begin:p - t + len(self.words) + self.slack])
                    if len(pairs) >= self.needed and pairs and self.named(pairs):
                        found.append((-len(pairs) / len(self.words), begin + pairs[0][1], begin + pairs[-1][1]))
        kept = []
        for share, first, last in sorted(found):
            if all(last < f or first > g for _, f, g in kept):
                kept.append((share, first, last))
        return [(-s, f, g) for s, f, g in sorted(kept, key=lambda k: k[1])]


def prepared(templates, coverage):
    common = Counter(w for text in templates.values() for w in set(words_of(text)[0]))
    return [Template(n, t, coverage, common) for n, t in templates.items()]


def find(text, templates):
    """(name, coverage, start, end) of all matches in one text, in code points."""
    lowered = text.lower()
    possible = [t for t in templates if any(k in lowered for k in t.keys)]
    if not possible:
        return []
    words, found = words_of(text)
    places_of = {}
    wanted = {k for t in possible for k in t.keys}
    for i, w in enumerate(words):
        if w in wanted:
            places_of.setdefault(w, []).append(i)
    return [(t.name, share, found[a][1], found[b][2]) for t in possible for share, a, b in t.matches(words, places_of)]


def scan(docs, templates=None, coverage=COVERAGE, id_col="doc_id", text_col="text"):
    """doc_id, license, coverage, start, end: every match of every template."""
    rows = with_nulls_as_text(docs, id_col, text_col)
    templates = TEMPLATES if templates is None else templates

    def run(batches):
        own = prepared(templates, coverage)
        for part, texts in slices(batches):
            out = [(i, *m) for i, t in enumerate(texts) for m in find(t, own)]
            columns = [pa.array([o[k] for o in out], kind) for k, kind in ((1, pa.string()), (2, pa.float64()), (3, pa.int64()), (4, pa.int64()))]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array([o[0] for o in out], pa.int64())), *columns], ["doc_id", "license", "coverage", "start", "end"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, license string, coverage double, start long, end long")
