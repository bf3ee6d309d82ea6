"""License scan by patience alignment of whole texts with license templates.

Seeds are three words in a row that a template has too, found for all texts at
once by their hashes; a text without a seed needs no more work. Runs of seeds
that go forward in the template form a chain, one for each copy in the text.
Its words are matched as they stand; what lies between its runs, and beside it
up to the template's length or the next copy, is aligned: anchors are the words
that occur exactly once in both sides; the longest increasing run of anchors
stays; common words at either end of a gap are matched, and the gaps between
anchors are aligned in the same way until no anchor is left. Coverage is the
share of the template's words that are matched; of overlapping hits the best
stays.

Cases: null and empty texts have no hits; words are runs of letters and digits,
case and punctuation do not count; ties go to the earlier template; repeated
rows have their hits each; null ids are kept; an empty table gives no rows;
other columns are ignored. A hit has at least one seed by definition.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from snapmart.llm import hashing
from snapmart.llm.common import texts

# Notices and license texts to look for.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version.""",
}
SEED = 3
COVERAGE = 0.8
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

Run = tuple[int, int, int]  # first word in the text and in the template, words
Hit = tuple[str, int, int, int, int]  # license, first byte, byte after the last, matched words, template words


def words(text: bytes) -> list[tuple[bytes, int, int]]:
    return [(m[0].lower(), m.start(), m.end()) for m in WORD.finditer(text)]


def longest_rise(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs (sorted by the first) whose second rises too."""
    tops: list[int] = []
    tails: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect.bisect_left(tops, b)
        if k == len(tops):
            tops.append(b)
            tails.append(i)
        else:
            tops[k], tails[k] = b, i
        back.append(tails[k - 1] if k else -1)
    out, i = [], tails[-1] if tails else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Matched positions of two word lists, in order."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, ii, j, jj = todo.pop()
        while i < ii and j < jj and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < ii and j < jj and a[ii - 1] == b[jj - 1]:
            ii, jj = ii - 1, jj - 1
            found.append((ii, jj))
        if i == ii or j == jj:
            continue
        in_a, in_b = Counter(a[i:ii]), Counter(b[j:jj])
        place = {w: n for n, w in enumerate(b[j:jj], j) if in_b[w] == 1}
        anchors = longest_rise([(n, place[w]) for n, w in enumerate(a[i:ii], i) if in_a[w] == 1 and w in place])
        for x, y in anchors:
            todo.append((i, x, j, y))
            found.append((x, y))
            i, j = x + 1, y + 1
        if anchors:
            todo.append((i, ii, j, jj))
    return sorted(found)


def chained(runs: list[list[int]], size: int) -> list[list[Run]]:
    """Chains of runs (sorted by the text), best first by matched words less half
    of what they shift along the text, so that a chain keeps to its copy."""
    score: list[float] = []
    back: list[int] = []
    trim: list[int] = []
    for j, (i, k, n) in enumerate(runs):
        best, before, cut = float(n), -1, 0
        for p in range(j - 1, -1, -1):
            pi, pk, pn = runs[p]
            if pi < i - 2 * size:
                break
            shift = max(0, pk + pn - k, pi + pn - i)
            if shift < n and pk < k and i + shift - pi - pn <= size:
                value = score[p] + n - shift - abs(i - k - pi + pk) / 2
                if value > best:
                    best, before, cut = value, p, shift
        score.append(best), back.append(before), trim.append(cut)
    taken: list[tuple[int, int]] = []
    out = []
    for j in sorted(range(len(runs)), key=lambda j: (-score[j], runs[j][0])):
        end, chain = runs[j][0] + runs[j][2], []
        at = bisect.bisect_left(taken, (end, 0))
        floor = taken[at - 1][1] if at else 0
        while j >= 0 and runs[j][0] >= floor:
            i, k, n = runs[j]
            cut = trim[j] if back[j] >= 0 and runs[back[j]][0] >= floor else 0
            chain.append((i + cut, k + cut, n - cut))
            j = back[j]
        if chain:
            taken.insert(at, (chain[-1][0], end))
            out.append(chain[::-1])
    return sorted(out)


def widened(text: list[bytes], template: list[bytes], chain: list[Run], lo: int, hi: int) -> list[tuple[int, int]]:
    """Matched pairs of a chain: its runs, and what aligns between and beside them in text[lo:hi]."""
    found, j = [], 0
    for i, k, n in [*chain, (hi, len(template), 0)]:
        found += ((lo + x, j + y) for x, y in align(text[lo:i], template[j:k]))
        found += ((i + x, k + x) for x in range(n))
        lo, j = i + n, k + n
    return found


class Templates:
    """Templates as words, and where their seeds stand in each."""

    def __init__(self, templates: dict[str, str]):
        self.words = [(name, [w for w, _, _ in words(t.encode())]) for name, t in templates.items()]
        self.seeds: dict[tuple[bytes, ...], list[tuple[int, int]]] = {}
        for n, (_, ws) in enumerate(self.words):
            for k in range(len(ws) - SEED + 1):
                self.seeds.setdefault(tuple(ws[k:k + SEED]), []).append((n, k))
        joined = [" ".join(s.decode() for s in seed) for seed in self.seeds]
        self.hashes = np.unique(np.concatenate([seed_hashes(*next(hashing.slices(pa.array([j])))[2:])[0] for j in joined]))

    def chains(self, text: list[bytes]) -> dict[int, list[list[Run]]]:
        """For each template, in the text's order, runs that go forward in both
        and may be one copy each; chains of one template never overlap."""
        runs: dict[int, list[list[int]]] = {}
        live: dict[tuple[int, int], list[int]] = {}  # template, diagonal -> newest run
        for i in range(len(text) - SEED + 1):
            for n, k in self.seeds.get(tuple(text[i:i + SEED]), ()):
                run = live.get((n, i - k))
                if run and run[0] + run[2] == i + SEED - 1:
                    run[2] += 1
                else:
                    run = live[n, i - k] = [i, k, SEED]
                    runs.setdefault(n, []).append(run)
        return {n: chained(found, len(self.words[n][1])) for n, found in runs.items()}

    def copies(self, plain: list[bytes], n: int, chains: list[list[Run]], coverage: float) -> Iterator[list[tuple[int, int]]]:
        """Matched pairs of each copy of template ``n``. Chains are widened up to
        the chains beside them first, which finds copies however close they
        stand, then up to the copies found, which joins what strays parted."""
        template = self.words[n][1]
        size, need = len(template), coverage * len(template)
        span = [(c[0][0], c[-1][0] + c[-1][2]) for c in chains]
        found: list[list[tuple[int, int]]] = []
        floor = 0
        for c, (first, end) in enumerate(span):
            ahead = span[c + 1][0] if c + 1 < len(span) else len(plain)
            pairs = widened(plain, template, chains[c], max(floor, first - size), min(ahead, end + size))
            found.append(pairs if len(pairs) >= need else [])
            floor = found[-1][-1][0] + 1 if found[-1] else end
        tops, ahead = [], len(plain)  # where the next copy starts
        for pairs in reversed(found):
            tops.append(ahead)
            ahead = pairs[0][0] if pairs else ahead
        floor = 0
        for (first, end), chain, pairs, ahead in zip(span, chains, found, reversed(tops), strict=True):
            if len(pairs) < size and floor <= first:
                lo, hi = max(floor, first - size), min(ahead, end + size)
                whole = [(lo + x, y) for x, y in align(plain[lo:hi], template)]
                pairs = max(pairs, widened(plain, template, chain, lo, hi), whole,
                            key=lambda p: (len(p), p[0][0] - p[-1][0] if p else 0))
            if pairs and len(pairs) >= need:
                floor = pairs[-1][0] + 1
                yield pairs

    def scan(self, raw: bytes, coverage: float) -> list[Hit]:
        text = words(raw)
        plain = [w for w, _, _ in text]
        hits = []
        for n, chains in self.chains(plain).items():
            name, template = self.words[n]
            for pairs in self.copies(plain, n, chains, coverage):
                hits.append((-len(pairs) / len(template), -len(pairs), n, text[pairs[0][0]][1], text[pairs[-1][0]][2], name, len(template)))
        kept: list[Hit] = []
        for _, matched, _, start, end, name, size in sorted(hits, key=lambda h: (h[1], h[0], h[2], h[3])):
            if all(end <= k[1] or k[2] <= start for k in kept):
                kept.append((name, start, end, -matched, size))
        return sorted(kept, key=lambda k: k[1])


def seed_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every SEED words in a row."""
    ws, at = hashing.word_hashes(data, off, hashing.LETTERS)
    row = np.repeat(np.arange(len(off) - 1), np.diff(at))
    if len(ws) < SEED:
        return ws[:0], row[:0]
    h = ws[:len(ws) - SEED + 1].copy()
    for k in range(1, SEED):
        h = h * np.uint64(0x9E3779B97F4A7C15) + ws[k:len(ws) - SEED + 1 + k]
    same = row[SEED - 1:] == row[:len(h)]
    return h[same], row[:len(h)][same]


HIT = "license string, start long, end long, matched_words int, template_words int, coverage double"


def _scan(batches: Iterator[pa.RecordBatch], templates: dict[str, str], coverage: float) -> Iterator[pa.RecordBatch]:
    known = Templates(templates)
    for b in batches:
        at, out = [], []
        for lo, hi, data, off in hashing.slices(b.column(1)):
            h, row = seed_hashes(data, off)
            place = np.minimum(np.searchsorted(known.hashes, h), len(known.hashes) - 1)
            for r in np.unique(row[known.hashes[place] == h]).tolist():
                for hit in known.scan(data[off[r]:off[r + 1]].tobytes(), coverage):
                    at.append(lo + r)
                    out.append((*hit, hit[3] / hit[4]))
        cols = list(zip(*out, strict=True)) or [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(
                cols, (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()), strict=True))],
            names=["doc_id", "license", "start", "end", "matched_words", "template_words", "coverage"])


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """One row per hit: doc_id, license, start and end (byte range), matched
    words, words of the template, coverage."""
    src = texts(docs)
    id_type = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(partial(_scan, templates=templates, coverage=coverage), f"doc_id {id_type}, {HIT}")
