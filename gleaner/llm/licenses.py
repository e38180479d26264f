"""License texts in documents: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are few, so their inverted index (fingerprint to template and word position) travels with the task. A document's
winnowed fingerprints are looked up in it; hits of one template near one diagonal are a candidate, and a local
alignment of the template with the words around that diagonal, within a band, reports how many of the template's words it
matched, in which runs, and where.

A passage that shares `GRAM + WINDOW - 1` words in a row with a template is always found. Licenses whose texts differ in a word or two
are told apart by these words: version, Lesser, Affero, NC, SA and ND must be matched where a template has them, and must not stand
in a match where it has none. The built-in templates are whole texts of short licenses, and the notices by which longer ones
are applied; callers pass whole texts of others.

Cases: a null or empty text has no matches; every occurrence of a template is reported; where matches overlap, the one
with more matched words stays, ties by coverage, then license id; repeated rows give repeated results; an empty table, or no
templates, gives an empty result; texts are scanned whole; other columns are ignored. Offsets are code points.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from gleaner.llm.common import by_text_bytes, id_and_text, map_texts

GRAM = 3
WINDOW = 2
BAND = 8
MIN_COVERAGE = 0.75



@dataclass(frozen=True)
class Template:
    """A license text or notice. Words in `must` tell it from its neighbours: a match without one of them is none."""

    license_id: str
    text: str
    must: tuple[str, ...] = ()


# Words that make another license of the same text.
TELLING = frozenset("lesser library affero nc sa nd noncommercial sharealike noderivatives noderivs".split())

# Whole texts of short public licenses, without their copyright lines.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""
ZERO_BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted."""
ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_OPENING = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met"""
BSD_CLAUSES = """Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the
License."""

# Notices and short forms.
NOTICES = (
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0.", ("apache", "2")),
    Template("Apache-2.0", APACHE_NOTICE, ("apache", "2")),
    Template("Apache-1.1", "Licensed under the Apache License, Version 1.1.", ("apache", "1")),
    Template("Apache-1.1", "The Apache Software License, Version 1.1", ("apache", "1")),
    Template("MIT", "Released under the MIT License.", ("mit",)),
    Template("MIT", "Licensed under the MIT License.", ("mit",)),
    Template("MIT", MIT),
    Template("ISC", f"{ISC} {ISC_DISCLAIMER}", ("provided",)),
    Template("ISC", "Licensed under the ISC License.", ("isc",)),
    Template("0BSD", f"{ZERO_BSD} {ISC_DISCLAIMER}"),
    Template("BSD-2-Clause", f"{BSD_OPENING}: 1. {BSD_CLAUSES} {BSD_DISCLAIMER}"),
    Template("BSD-3-Clause", f"{BSD_OPENING}: 1. {BSD_CLAUSES} {BSD_THIRD} {BSD_DISCLAIMER}", ("endorse",)),
    Template("BSD", BSD_OPENING),
    Template("Unlicense", UNLICENSE),
    Template("Zlib", ZLIB),
    Template("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla", "2")),
    Template("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1", ("mozilla", "1")),
    Template("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0", ("eclipse", "2")),
    Template("EPL-1.0", "made available under the terms of the Eclipse Public License v1.0", ("eclipse", "v1")),
    Template("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication", ("cc0", "1")),
)
_GNU = {"GPL": "", "LGPL": "Lesser ", "AGPL": "Affero "}
_GNU_VERSIONS = {"GPL": ("2.0", "3.0"), "LGPL": ("2.1", "3.0"), "AGPL": ("3.0",)}
_COMMONS = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
_COMMONS_KINDS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")


def _gnu() -> list[Template]:
    """Notices of the GNU licenses by kind and version."""
    made = []
    for kind, versions in _GNU_VERSIONS.items():
        for version in versions:
            short = version.removesuffix(".0")
            must = (*_GNU[kind].lower().split(), *short.split("."))
            name = f"GNU {_GNU[kind]}General Public License"
            for text in (
                f"This work is licensed under the {name}, version {short}.",
                f"under the terms of the {name} as published by the Free Software Foundation; version {short} of the License.",
                f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by"
                f" the Free Software Foundation, either version {short} of the License, or (at your option) any later version.",
            ):
                made.append(Template(f"{kind}-{version}", text, must))
    return made


def _commons() -> list[Template]:
    """Short and long forms of the Creative Commons licenses."""
    made = []
    for kind in _COMMONS_KINDS:
        for version in ("3.0", "4.0"):
            parts = kind.split("-")
            scope = "International" if version == "4.0" else "Unported"
            long = "-".join(_COMMONS[part] for part in parts)
            major = version.split(".")[0]
            made.append(Template(f"CC-{kind}-{version}", f"Licensed under CC {kind} {version}.", ("cc", *kind.lower().split("-"), major)))
            made.append(
                Template(
                    f"CC-{kind}-{version}", f"licensed under a Creative Commons {long} {version} {scope} License",
                    ("commons", *(_COMMONS[part].lower() for part in parts), major),
                )
            )
    return made


_WORD = re.compile(r"\w+")
_MUL = np.uint64(0x9E3779B97F4A7C15)


def word_codes(words: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint64, len(words))


def grams(codes: np.ndarray) -> np.ndarray:
    """Hash of every GRAM words in a row."""
    if len(codes) < GRAM:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(codes) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        total = total * _MUL + codes[k : len(codes) - GRAM + 1 + k]
    return (total ^ (total >> np.uint64(29))) * _MUL


def winnow(hashes: np.ndarray) -> np.ndarray:
    """Positions of the smallest hash of each WINDOW hashes in a row, the rightmost of equals."""
    if len(hashes) <= WINDOW:
        return np.flatnonzero(hashes == hashes.min()) if len(hashes) else np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW)[:, ::-1]
    return np.unique(np.arange(len(view)) + WINDOW - 1 - view.argmin(axis=1))


@dataclass
class Index:
    """The inverted index: sorted fingerprints with their template and word position."""

    names: list[str]
    words: list[list[str]]
    must: list[frozenset[str]]
    hashes: np.ndarray
    template: np.ndarray
    position: np.ndarray

    @staticmethod
    def of(templates: list[Template]) -> "Index":
        names, words, must, h, t, p = [], [], [], [], [], []
        for template in templates:
            name, own = template.license_id, _WORD.findall(template.text.lower())
            if not own:
                continue
            hashes = grams(word_codes(own))
            # Every gram of a template is listed: a document's choice then always finds its partner.
            h.append(hashes)
            t.append(np.full(len(hashes), len(names)))
            p.append(np.arange(len(hashes)))
            names.append(name)
            words.append(own)
            must.append(frozenset(template.must) | (TELLING & set(own)))
        if not names:
            return Index([], [], [], np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        hashes = np.concatenate(h)
        order = np.argsort(hashes, kind="stable")
        return Index(names, words, must, hashes[order], np.concatenate(t)[order], np.concatenate(p)[order])


@dataclass(frozen=True)
class Match:
    license_id: str
    coverage: float
    matched_words: int
    template_words: int
    start: int
    end: int
    runs: tuple[tuple[int, int], ...]


def align(template: list[str], words: list[str], diagonal: int, band: int = BAND) -> list[tuple[int, int]]:
    """Matched pairs (template word, document word) of the best local alignment near a diagonal.

    Scores: 2 for equal words, -1 for unequal ones or a gap; cells further than `band` from the diagonal are never visited.
    """
    rows, width = len(template), 2 * band + 1
    score = np.zeros((rows + 1, width + 2), np.int64)
    move = np.zeros((rows + 1, width + 2), np.int8)
    best, at = 0, (0, 0)
    for i in range(1, rows + 1):
        for b in range(1, width + 1):
            j = i + diagonal + (b - 1 - band)  # 1-based place in the document
            if not 1 <= j <= len(words):
                continue
            same = template[i - 1] == words[j - 1]
            options = (
                (0, 0),
                (int(score[i - 1, b]) + (2 if same else -1), 1),
                (int(score[i - 1, b + 1]) - 1 if b < width else -1, 2),
                (int(score[i, b - 1]) - 1 if b > 1 else -1, 3),
            )
            value, step = max(options)
            score[i, b], move[i, b] = value, step
            if value > best:
                best, at = value, (i, b)
    pairs = []
    i, b = at
    while i > 0 and score[i, b] > 0:
        j, step = i + diagonal + (b - 1 - band), move[i, b]
        if step == 1:
            if template[i - 1] == words[j - 1]:
                pairs.append((i - 1, j - 1))
            i -= 1
        elif step == 2:
            i, b = i - 1, b + 1
        else:
            b -= 1
    return pairs[::-1]


def telling(index: Index, template: int, words: list[str], pairs: list[tuple[int, int]]) -> bool:
    """Whether the words that make this license are matched, and none that makes another stands between."""
    own, taken = index.words[template], {j for _, j in pairs}
    if not index.must[template] <= {own[i] for i, _ in pairs}:
        return False
    return not any(words[j] in TELLING for j in range(pairs[0][1], pairs[-1][1] + 1) if j not in taken)


def scan(text: str, index: Index, min_coverage: float = MIN_COVERAGE) -> list[Match]:
    """All license matches of one text, by start."""
    found = list(_WORD.finditer(text))
    words = [m[0].lower() for m in found]
    hashes = grams(word_codes(words))
    if not len(hashes) or not len(index.hashes):
        return []
    places = winnow(hashes)
    first = np.searchsorted(index.hashes, hashes[places], "left")
    count = np.searchsorted(index.hashes, hashes[places], "right") - first
    if not count.any():
        return []
    at = np.repeat(places, count)
    entry = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    hits = sorted(
        {(int(t), int(d) - int(p)) for t, p, d in zip(index.template[entry], index.position[entry], at, strict=True)}
    )
    # Hits of one template whose diagonals lie within a band, narrower for short templates, are one candidate.
    reach = lambda template: min(BAND, len(index.words[template]) // 2)
    candidates, last = [], None
    for template, diagonal in hits:
        if last is None or last[0] != template or diagonal - last[1] > reach(template):
            candidates.append((template, diagonal))
            last = (template, diagonal)
    matches = []
    for template, diagonal in candidates:
        half = reach(template) // 2
        pairs = align(index.words[template], words, diagonal + half, reach(template) + half)
        coverage = len(pairs) / len(index.words[template])
        if pairs and coverage >= min_coverage and telling(index, template, words, pairs):
            runs = []
            for _, j in pairs:
                if runs and j == runs[-1][1] + 1:
                    runs[-1][1] = j
                else:
                    runs.append([j, j])
            spans = tuple((found[a].start(), found[b].end()) for a, b in runs)
            matches.append(
                Match(index.names[template], round(coverage, 4), len(pairs), len(index.words[template]), spans[0][0], spans[-1][1], spans)
            )
    matches.sort(key=lambda m: (-m.matched_words, -m.coverage, m.license_id, m.start))
    kept: list[Match] = []  # by start, none overlapping
    for m in matches:
        at = bisect_right(kept, m.start, key=lambda k: k.start)
        if (at == 0 or kept[at - 1].end <= m.start) and (at == len(kept) or kept[at].start >= m.end):
            kept.insert(at, m)
    return kept


def default_templates() -> list[Template]:
    return [*NOTICES, *_gnu(), *_commons()]


def scan_documents(frame: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id",
                   text_col: str = "text", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(id, license_id, coverage, matched_words, template_words, start, end, runs) of every match."""
    index = Index.of(default_templates() if templates is None else templates)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_text_bytes(batches, "text"):
            rows = [
                (key, m.license_id, m.coverage, m.matched_words, m.template_words, m.start, m.end,
                 [{"start": a, "end": b} for a, b in m.runs])
                for key, text in zip(batch["id"].tolist(), batch["text"], strict=True)
                for m in scan(text, index, min_coverage)
            ]
            names = ["id", "license_id", "coverage", "matched_words", "template_words", "start", "end", "runs"]
            yield pd.DataFrame(rows, columns=names)

    source = id_and_text(frame, id_col, text_col)
    return map_texts(
        source,
        work,
        "license_id string, coverage double, matched_words int, template_words int, start int, end int,"
        " runs array<struct<start:int,end:int>>",
    )
