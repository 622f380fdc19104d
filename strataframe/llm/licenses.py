"""License scans by patience alignment against template texts.

Words that occur once in both a stretch of text and a template anchor the alignment; the longest increasing run of
anchors stays, and the gaps between them are aligned the same way. Stretches are windows of the text that hold enough
of a template's words, found by running sums over the whole text; the share of the template's words that aligns is the
coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import small_batches

WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
VERSION = re.compile(r"^v?(\d+(?:\.\d+)*?)(?:\.0)*$")
#: Notices and texts of common licenses, and of those that share most of their words.
MIT_TEXT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
)
BSD_TEXT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
ADVERTISING = " All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization."
ENDORSEMENT = " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
AS_IS = " THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
BSD_AS_IS = " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
ISC_TEXT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_AS_IS = " THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
#: How whole texts start; with their names, versions and dates they tell which text follows.
VERBATIM = " Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
GNU_DATES = {"GPL-1.0": "February 1989 Copyright (C) 1989", "GPL-2.0": "June 1991 Copyright (C) 1989, 1991", "GPL-3.0": "29 June 2007 Copyright (C) 2007", "LGPL-2.0": "June 1991 Copyright (C) 1991", "LGPL-2.1": "February 1999 Copyright (C) 1991, 1999", "LGPL-3.0": "29 June 2007 Copyright (C) 2007", "AGPL-3.0": "19 November 2007 Copyright (C) 2007"}
HEADS = (
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. License shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
    ("MPL-1.1", "MOZILLA PUBLIC LICENSE Version 1.1 1. Definitions. 1.0.1. Commercial Use means distribution or otherwise making the Covered Code available to a third party."),
    ("CC0-1.0", "CC0 1.0 Universal Statement of Purpose The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an owner) of an original work of authorship and/or a database (each, a Work)."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under the CC0 1.0 Universal Public Domain Dedication"),
    ("GFDL-1.2", "GNU Free Documentation License Version 1.2, November 2002 Copyright (C) 2000,2001,2002" + VERBATIM),
    ("GFDL-1.3", "GNU Free Documentation License Version 1.3, 3 November 2008 Copyright (C) 2000, 2001, 2002, 2007, 2008" + VERBATIM),
    *((f"GFDL-{v}-or-later", f"Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version {v} or any later version published by the Free Software Foundation") for v in ("1.1", "1.2", "1.3")),
    ("Artistic-1.0-Perl", "The Artistic License Preamble The intent of this document is to state the conditions under which a Package may be copied, such that the Copyright Holder maintains some semblance of artistic control over the development of the package"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"),
    ("Zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
)
GNU = (("GPL-1.0", "", "1"), ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.0", "Library ", "2"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3"))
FLAVOURS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
VERSIONS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}


def _gnu() -> Iterator[tuple[str, str]]:
    """The one-line and the long notices, each of one version and of any later one."""
    for name, kind, version in GNU:
        line = f"This work is licensed under the GNU {kind}General Public License, version {version}"
        yield name, line
        yield f"{name}-or-later", f"{line} or later"
        subject = "library" if kind in ("Library ", "Lesser ") else "program"
        terms = f"This {subject} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License"
        yield f"{name}-or-later", f"{terms} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
        yield f"{name}-only", f"{terms} as published by the Free Software Foundation, version {version} of the License."
        yield f"{name}-only", f"{terms} version {version} as published by the Free Software Foundation."
        yield name, f"GNU {kind}General Public License Version {version}, {GNU_DATES[name]}{VERBATIM}"


def _creative_commons() -> Iterator[tuple[str, str]]:
    """The short and the long notices, with hyphens and with spaces between the parts of a name."""
    for version, area in VERSIONS.items():
        for short, long in FLAVOURS.items():
            for join in "- " if "-" in short else "-":
                spelled = long if version == "4.0" else long.replace("NoDerivatives", "NoDerivs")
                yield f"CC-{short}-{version}", f"Licensed under CC {short.replace("-", join)} {version}"
                yield f"CC-{short}-{version}", f"This work is licensed under a Creative Commons {spelled.replace("-", join)} {version} {area} License"


TEMPLATES = (
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "".join(MIT_TEXT)),
    ("MIT-0", "Licensed under the MIT No Attribution License"),
    ("MIT-0", MIT_TEXT[0]),
    ("JSON", "".join(MIT_TEXT) + " The Software shall be used for Good, not Evil."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-2-Clause", BSD_TEXT),
    ("BSD-3-Clause", BSD_TEXT + ENDORSEMENT),
    ("BSD-4-Clause", BSD_TEXT + ADVERTISING + ENDORSEMENT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    (
        "HPND",
        "Permission to use, copy, modify, distribute, and sell this software and its documentation for any purpose is hereby granted without fee, provided that the above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation",
    ),
    (
        "MPL-1.1",
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/ Software distributed under the License is distributed on an AS IS basis, WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License for the specific language governing rights and limitations under the License.",
    ),
    ("MIT", "".join(MIT_TEXT) + AS_IS),
    ("MIT-0", MIT_TEXT[0] + "." + AS_IS),
    ("BSD-2-Clause", BSD_TEXT + BSD_AS_IS),
    ("BSD-3-Clause", BSD_TEXT + ENDORSEMENT + BSD_AS_IS),
    ("ISC", ISC_TEXT + ", provided that the above copyright notice and this permission notice appear in all copies." + ISC_AS_IS),
    ("0BSD", ISC_TEXT + "." + ISC_AS_IS),
    *HEADS,
    *_gnu(),
    *_creative_commons(),
)
#: What tells a license from its siblings, by the start of its name: runs of words that must align unbroken wherever a
#: template has them.
TELLING = {
    "MIT": ("mit license", "mit no attribution", "notice"),
    "JSON": ("notice", "good not evil"),
    "MIT-0": ("sublicense",),
    "ISC": ("notice",),
    "0BSD": ("fee",),
    "HPND": ("supporting",),
    "Apache-": ("apache", "2.0"),
    "MPL-": ("mozilla", "1.1", "2.0"),
    "CC0-": ("cc0",),
    "GFDL-": ("free documentation", "1.1", "1.2", "1.3", "later"),
    "Artistic": ("artistic license",),
    "Unlicense": ("unencumbered",),
    "BSL-": ("organization",),
    "Zlib": ("alter",),
    "EPL-": ("eclipse", "2.0"),
    "BSD-2": ("reproduce",),
    "BSD-3": ("reproduce", "endorse"),
    "BSD-4": ("reproduce", "endorse", "advertising"),
    **{name: ("general", version, "later") for name, _, version in GNU},
    **{f"CC-{short}-{v}": tuple(f"{x} {v}" for name in (short, long, long.replace("NoDerivatives", "NoDerivs")) for x in (name, name.replace("-", " "))) for short, long in FLAVOURS.items() for v in VERSIONS},
}
#: Words that make another license if one of them stands before this word, and words that may stand inside a run.
BEFORE, KINDS, BETWEEN = "general", ("lesser", "library", "affero"), ("version", "v")
SHORT, COVER_SHORT, COVER_LONG = 20, 0.85, 0.6
CLOSE, DENSITY = 0.75, 1 / 3  # least length of a template over that of the stretch of text that it is spread over


def words_of(text: str | None) -> list[str]:
    """Lower-cased words: runs of letters and digits, with the single dots and hyphens inside them."""
    return WORD.findall((text or "").lower())


def plain(word: str) -> str:
    """A word as it is compared: versions without a v before them and without .0 after them."""
    return VERSION.sub(r"\1", word)


def increasing(values: Sequence[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence, in order."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        before[i] = at[k - 1] if k else -1
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Pairs (place in a, place in b) of a patience alignment, increasing in both.

    Equal heads and tails match first; then words that are unique in both anchor, and each gap is aligned by itself.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        here, there = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if there[b[j]] == 1}
        shared = [(i, place[a[i]]) for i in range(a0, a1) if here[a[i]] == 1 and a[i] in place]
        anchors = [shared[k] for k in increasing([j for _, j in shared])]
        if not anchors:
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


@dataclass(frozen=True)
class Finding:
    license: str
    start: int  # words of the text, from and up to
    end: int
    matched: int
    coverage: float


class Scanner:
    """Templates as arrays of word numbers; words that no template has are -1."""

    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, density: float = DENSITY):
        self.density = density
        texts = [[plain(w) for w in words_of(t)] for _, t in templates]
        self.numbers = {w: i for i, w in enumerate(dict.fromkeys([*KINDS, *BETWEEN, BEFORE, *(w for t in texts for w in t)]))}
        self.templates = [(name, [self.numbers[w] for w in t]) for (name, _), t in zip(templates, texts, strict=True) if t]
        self.kinds, self.between, self.before = {self.numbers[w] for w in KINDS}, {self.numbers[w] for w in BETWEEN}, self.numbers[BEFORE]
        self.runs = [self._runs(name, t) for name, t in self.templates]
        self.member = np.zeros((len(self.templates), len(self.numbers) + 1), bool)  # the last column is for -1
        self.tells = np.zeros(self.member.shape, np.float32)
        for k, (_, t) in enumerate(self.templates):
            self.member[k, t] = True
            self.tells[k, [t[j] for places in self.runs[k] for j in places[0]]] = 1

    def _runs(self, name: str, template: list[int]) -> list[list[range]]:
        """The places of each telling run that the template has."""
        out = []
        for run in dict.fromkeys(run for start, runs in TELLING.items() if name.startswith(start) for run in runs):
            ids = [self.numbers.get(plain(w), -1) for w in words_of(run)]
            places = [range(j, j + len(ids)) for j in range(len(template) - len(ids) + 1) if template[j : j + len(ids)] == ids]
            if places:
                out.append(places)
        return out

    def scan(self, words: Sequence[str]) -> list[Finding]:
        """Findings that do not overlap, in the order of the text; of overlapping ones that which matches most words stays."""
        number = self.numbers.get
        ids = np.fromiter((number(plain(w) if w[-1].isdigit() else w, -1) for w in words), np.int32, len(words))
        absent = np.ones(len(self.numbers) + 1, np.float32)
        absent[ids] = 0
        found: list[Finding] = []
        places: dict[int, np.ndarray] = {}
        for k in np.flatnonzero(self.tells @ absent == 0):
            found += self._find(ids, k, places)
        out: list[Finding] = []
        for f in sorted(found, key=lambda f: (-f.matched, -f.coverage, f.end - f.start, f.start, f.license)):
            if all(f.end <= g.start or f.start >= g.end for g in out):
                out.append(f)
        return sorted(out, key=lambda f: f.start)

    def _find(self, ids: np.ndarray, k: int, places: dict[int, np.ndarray]) -> Iterator[Finding]:
        """Findings of a template: first where its words stand close together, then in what is left."""
        name, template = self.templates[k]
        telling = {template[j] for alternatives in self.runs[k] for j in alternatives[0]}
        for word in telling - places.keys():
            places[word] = np.flatnonzero(ids == word)
        near = min((places[word] for word in telling), key=len, default=None)
        stretches = _around(near, int(np.ceil(len(template) / self.density)), len(ids))
        for density in sorted({max(CLOSE, self.density), self.density}, reverse=True):
            size = int(np.ceil(len(template) / density))
            found = [f for a, b in stretches for f in self._spread(ids[a:b], a, size, telling, k)]
            yield from found
            for f in found:
                ids = ids.copy()
                ids[f.start : f.end] = -1

    def _spread(self, ids: np.ndarray, offset: int, size: int, telling: set[int], k: int) -> Iterator[Finding]:
        """Findings of a template that is spread over size words at most, in a stretch of the text from offset on."""
        name, template = self.templates[k]
        least = COVER_SHORT if len(template) <= SHORT else COVER_LONG
        need, marks = int(np.ceil(least * len(template) - 1e-9)), self.member[k][ids]
        if np.count_nonzero(marks) < need:
            return
        ends = np.minimum(np.arange(len(marks)) + size, len(marks))
        within = lambda hit: (total := np.concatenate([[0], np.cumsum(hit)]))[ends] - total[:-1]
        held = within(marks)
        told = held >= need
        for word in telling:  # no window without them is told from its siblings
            told &= within(ids == word) > 0
        enough, at, step = np.flatnonzero(told), 0, max(1, len(template) // 16)
        while (i := int(np.searchsorted(enough, at))) < len(enough):
            first = int(enough[i])
            start = first + int((held * told)[first : first + size].argmax())  # the fullest window that begins within this one
            inside = start + np.flatnonzero(marks[start : start + size])
            pairs = _centred(ids, int(inside[0]), int(inside[-1]) + 1, template)
            coverage = len(pairs) / len(template)
            at = start + step
            if pairs and coverage >= least - 1e-9 and self._told(ids, pairs, template, self.runs[k]):
                yield Finding(name, offset + pairs[0][0], offset + pairs[-1][0] + 1, len(pairs), coverage)
                at = max(at, pairs[-1][0] + 1)

    def _told(self, ids: np.ndarray, pairs: list[tuple[int, int]], template: list[int], runs: list[list[range]]) -> bool:
        """Whether an alignment has what tells the template from its siblings."""
        place = {j: i for i, j in pairs}
        unbroken = lambda a, b: all(int(x) in self.between for x in ids[a + 1 : b])
        whole = lambda run: all(j in place for j in run) and all(unbroken(place[j], place[j + 1]) for j in run[:-1])
        kind = lambda seq, k: int(seq[k - 1]) if k and int(seq[k - 1]) in self.kinds else None
        return all(any(map(whole, places)) for places in runs) and all(kind(ids, i) == kind(template, j) for i, j in pairs if template[j] == self.before)


def _around(near: np.ndarray | None, size: int, n: int) -> list[tuple[int, int]]:
    """The stretches of n words that lie within size words of a place in near; all of them if that is None."""
    if near is None:
        return [(0, n)]
    out: list[tuple[int, int]] = []
    for p in near.tolist():
        a, b = max(0, p - size + 1), min(n, p + size)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _centred(ids: np.ndarray, a0: int, a1: int, template: list[int]) -> list[tuple[int, int]]:
    """The alignment of a window, or of where it says that the whole template lies, as long as that matches more."""
    best: list[tuple[int, int]] = []
    while True:
        pairs = [(a0 + i, j) for i, j in align(ids[a0:a1].tolist(), template)]
        if len(pairs) <= len(best):
            return best
        best, slack = pairs, len(template) // 10
        (i, j), (m, n) = pairs[0], pairs[-1]
        spread = max(1.0, (m - i + 1) / (n - j + 1))  # words of the text for one of the template
        a0, a1 = max(0, i - int(j * spread) - slack), min(len(ids), m + int((len(template) - n) * spread) + slack)


def _scanner(templates: Sequence[tuple[str, str]], density: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates, density)
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                words = words_of(text if isinstance(text, str) else None)
                found = scanner.scan(words)
                rows.append((doc_id, len(words), [{"license": f.license, "start": f.start, "end": f.end, "matched": f.matched, "coverage": f.coverage} for f in found]))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "findings"]).astype({"doc_id": "Int64"})

    return run


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES, density: float = DENSITY) -> DataFrame:
    """(doc_id, n_words, findings), one row a document; findings: array of (license, start, end, matched, coverage).

    start and end count words of the whole text. A finding covers 0.85 of a template of up to 20 words, 0.6 of a longer
    one, and has the words that tell the template's license from its siblings (TELLING): a variant without a template
    gives none. Whole license texts are found by their start and by the notices in them; templates takes others, as
    (name, text). density: a template is looked for in stretches of up to its length over density words. Null, empty and wordless texts have no finding; repeated rows and null ids keep their rows; other columns are
    not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(_scanner(tuple(templates), density), "doc_id long, n_words long, findings array<struct<license:string,start:long,end:long,matched:long,coverage:double>>")
