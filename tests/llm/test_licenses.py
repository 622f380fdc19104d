import os
import random
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataframe.llm import licenses as li

SCHEMA = "doc_id long, text string, findings int, n_words string"
PROSE = "the of and thonre wherer under this is licensed enti to a version ndat public work free copy".split()


def longest_common(a, b):
    @lru_cache(None)
    def best(i, j):
        return 0 if i == len(a) or j == len(b) else 1 + best(i + 1, j + 1) if a[i] == b[j] else max(best(i + 1, j), best(i, j + 1))

    return best(0, 0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=12), st.lists(st.sampled_from("abcdefgh"), max_size=12))
def test_alignment_is_a_common_subsequence(a, b):
    pairs = li.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and all(p < q and r < s for (p, r), (q, s) in zip(pairs, pairs[1:], strict=False))
    assert len(pairs) <= longest_common(tuple(a), tuple(b))
    if len(set(a)) == len(a) and len(set(b)) == len(b):
        assert len(pairs) == longest_common(tuple(a), tuple(b))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=9))
def test_increasing_is_longest(values):
    places = li.increasing(values)
    picked = [values[i] for i in places]
    assert places == sorted(places) and all(x < y for x, y in zip(picked, picked[1:], strict=False))
    subsets = [[v for k, v in enumerate(values) if m >> k & 1] for m in range(1 << len(values))]
    assert len(picked) == max(len(s) for s in subsets if all(x < y for x, y in zip(s, s[1:], strict=False)))


def test_every_template_is_found_in_prose():
    rng = random.Random(1)
    scanner = li.Scanner()
    for name, text in li.TEMPLATES:
        before, after = ([rng.choice(PROSE) for _ in range(300)] for _ in range(2))
        words = before + li.words_of(text) + after
        (f,) = [f for f in scanner.scan(words) if f.license == name]
        assert f.coverage == 1.0 and f.start <= 300 and f.end >= 300 + len(li.words_of(text)) and scanner.scan(before) == []


def test_edits_repeats_and_neighbours():
    scanner = li.Scanner()
    names = lambda text: [f.license for f in scanner.scan(li.words_of(text))]
    apache = "Licensed under the Apache License, Version 2.0."
    assert names(f"{apache}\n{apache}\n{apache} ndat") == ["Apache-2.0"] * 3
    assert names("LICENSED under CC by-nc 4.0! and Licensed under CC BY 4.0") == ["CC-BY-NC-4.0", "CC-BY-4.0"]
    assert names("This work is licensed under the GNU General Public License, version 2, thonre") == ["GPL-2.0"]
    long = li.words_of(li.TEMPLATES[2][1])
    for drop, found in ((0.2, True), (0.7, False)):
        kept = [w for w in long if random.Random(w + str(drop)).random() > drop]
        assert ("MIT" in names(" ".join(kept))) == found
    assert names("the license of the work under this version is free") == [] == names("")


def test_siblings_keep_their_names():
    scanner = li.Scanner()
    names = lambda text: [f.license for f in scanner.scan(li.words_of("thonre " * 50 + text + " wherer" * 50))]
    gnu = "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version. This {} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {}General Public License for more details."
    for name, subject, kind, version in (("GPL-2.0", "program", "", "2"), ("GPL-2.0", "library", "", "2"), ("GPL-3.0", "program", "", "3.0"), ("LGPL-2.0", "library", "Library ", "2"), ("LGPL-2.1", "library", "Lesser ", "2.1"), ("LGPL-3.0", "program", "Lesser ", "3"), ("AGPL-3.0", "program", "Affero ", "3")):
        assert names(gnu.format(subject, kind, version, subject, kind)) == [f"{name}-or-later"], (name, subject)
    assert names(gnu.format("program", "", "4", "program", "")) == [] == names(gnu.format("program", "Affero ", "2", "program", "Affero "))
    assert names(gnu.format("program", "", "2", "program", "").replace(", or (at your option) any later version", "")) == ["GPL-2.0-only"]
    assert names("This work is licensed under the GNU Lesser General Public License, version 2.1") == ["LGPL-2.1"]
    assert names("This work is licensed under the GNU General Public License, version 2 or any later version") == ["GPL-2.0-or-later"]
    two = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    three = " Neither the name of Foo nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    four = " 3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by Foo. 4."
    assert (names(two), names(two + " 3." + three), names(two + four + three)) == (["BSD-2-Clause"], ["BSD-3-Clause"], ["BSD-4-Clause"])
    for words, version, name in (("Attribution-NonCommercial-NoDerivatives", "4.0 International", "CC-BY-NC-ND-4.0"), ("Attribution NonCommercial ShareAlike", "4.0 International", "CC-BY-NC-SA-4.0"), ("Attribution", "3.0 Unported", "CC-BY-3.0"), ("Attribution-NoDerivs", "3.0 Unported", "CC-BY-ND-3.0")):
        assert names(f"This work is licensed under a Creative Commons {words} {version} License") == [name]
    assert names("Licensed under CC BY NC 4.0") == ["CC-BY-NC-4.0"] and names("Licensed under CC BY version 4.0") == ["CC-BY-4.0"]
    assert names("This work is licensed under a Creative Commons Attribution 9.0 International License") == [] == names("Licensed under the Apache License, Version 1.1")
    assert names("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.") == ["0BSD"]
    assert names(li.MIT_TEXT[0] + " this free copy") == ["MIT-0"] and names("".join(li.MIT_TEXT)) == ["MIT"]


def plainly(scanner, words):
    """Licenses that plain alignment finds: every template against every stretch of the text, by no filter at all."""
    ids = li.np.array([scanner.numbers.get(li.plain(w), -1) for w in words], dtype=li.np.int32)
    found = set()
    for (name, template), runs in zip(scanner.templates, scanner.runs, strict=True):
        least = li.COVER_SHORT if len(template) <= li.SHORT else li.COVER_LONG
        size = -(-len(template) * 3 // 1)
        for a in range(0, max(1, len(ids) - len(template) // 2), max(1, len(template) // 8)):
            if name in found:
                break
            pairs = [(a + i, j) for i, j in li.align(ids[a : a + size].tolist(), template)]
            if len(pairs) >= least * len(template) - 1e-9 and scanner._told(ids, pairs, template, runs):
                found.add(name)
    return found


def test_recall_against_plain_alignment():
    """Templates with words left out, changed and pushed apart: what plain alignment finds, the scan finds."""
    rng = random.Random(9)
    scanner = li.Scanner()
    hits = misses = 0
    for name, text in li.TEMPLATES[::3]:
        words = []
        for w in li.words_of(text):
            if rng.random() > 0.05:
                words += [w] + [rng.choice(PROSE)] * (rng.random() < 0.3) * rng.randrange(1, 4)
        words = rng.choices(PROSE, k=40) + words + rng.choices(PROSE, k=40)
        ids = li.np.array([scanner.numbers.get(li.plain(w), -1) for w in words], dtype=li.np.int32)
        found = {f.license for k in range(len(scanner.templates)) for f in scanner._find(ids, k, {})}  # overlapping ones included
        plain = plainly(scanner, words)
        hits += name in plain and name in found
        misses += name in plain and name not in found
    assert hits > 20 and hits >= 0.95 * (hits + misses)  # 36 of 37: one whose words lie among the same words of the prose


@pytest.mark.parametrize("between", [1, 2])
def test_words_between(between):
    scanner = li.Scanner()
    long = [(n, t) for n, t in li.TEMPLATES if len(li.words_of(t)) > 40 and not any(len(r.split()) > 1 for s, rs in li.TELLING.items() if n.startswith(s) for r in rs)]
    for name, text in long:
        words = [x for w in li.words_of(text) for x in [w] + ["qqq"] * between]
        kinds = [i for i, w in enumerate(words) if w in ("lesser", "library", "affero")]
        words = [w for i, w in enumerate(words) if not any(k < i <= k + between for k in kinds)]
        assert name in {f.license for f in scanner.scan(words)}, name


def test_whole_texts():
    folder = "/usr/share/common-licenses"
    want = {"Apache-2.0": {"Apache-2.0"}, "BSD": {"BSD-3-Clause"}, "CC0-1.0": {"CC0-1.0"}, "MPL-1.1": {"MPL-1.1"}, "MPL-2.0": {"MPL-2.0"}, "Artistic": {"Artistic-1.0-Perl"}, "LGPL-3": {"LGPL-3.0"}}
    want |= {f: {f"{f.split('-')[0]}-{v}", f"{f.split('-')[0]}-{v}-or-later"} for f, v in (("GPL-1", "1.0"), ("GPL-2", "2.0"), ("GPL-3", "3.0"), ("LGPL-2", "2.0"), ("LGPL-2.1", "2.1"), ("GFDL-1.2", "1.2"), ("GFDL-1.3", "1.3"))}
    scanner = li.Scanner()
    for name in [n for n in want if os.path.isfile(f"{folder}/{n}")]:
        text = open(f"{folder}/{name}", errors="replace").read()
        assert {f.license for f in scanner.scan(li.words_of(text))} == want[name], name
    with_terms = lambda terms: [f.license for f in scanner.scan(li.words_of(terms))]
    assert with_terms("".join(li.MIT_TEXT) + li.AS_IS) == ["MIT"] and with_terms(li.MIT_TEXT[0] + li.AS_IS) == ["MIT-0"]
    assert with_terms(li.BSD_TEXT + li.BSD_AS_IS) == ["BSD-2-Clause"] and with_terms(li.BSD_TEXT + li.ENDORSEMENT + li.BSD_AS_IS) == ["BSD-3-Clause"]
    assert with_terms(li.ISC_TEXT + ", provided that the above copyright notice and this permission notice appear in all copies." + li.ISC_AS_IS) == ["ISC"] and with_terms(li.ISC_TEXT + li.ISC_AS_IS) == ["0BSD"]


def test_dense_texts_take_linear_time():
    scanner = li.Scanner()
    for word in ("the", "license", "under the"):
        assert scanner.scan(word.split() * 60_000) == []


def test_documents(spark):
    rows = [(1, "x " * 40_000 + "Released under the MIT License." + " y" * 40_000), (2, None), (3, ""), (None, "Licensed under CC BY 4.0"), (4, "plain"), (4, "plain"), (5, "...")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.n_words, [(f.license, f.start, f.end, f.coverage) for f in r.findings]) for r in li.scan_licenses(df).collect()), key=repr)
    want = [(1, 80_005, [("MIT", 40_000, 40_005, 1.0)]), (2, 0, []), (3, 0, []), (None, 5, [("CC-BY-4.0", 0, 5, 1.0)]), (4, 1, []), (4, 1, []), (5, 0, [])]
    assert got == sorted(want, key=repr)
    assert li.scan_licenses(df.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables")
def test_license_lines_of_the_tables(spark):
    lines = {"Released under the MIT License": "MIT", "Licensed under the Apache License, Version 2.0": "Apache-2.0", "licensed under the GNU General Public License, version 3": "GPL-3.0", "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0"}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: (r.text or "").lower() for r in docs.collect()}
    got = {r.doc_id: {f.license for f in r.findings} for r in li.scan_licenses(docs).collect()}
    for i, text in texts.items():
        plain = " ".join(li.words_of(text))
        assert got[i] == {name for line, name in lines.items() if " ".join(li.words_of(line)) in plain}, i
