import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataframe.llm import components as comp
from strataframe.llm import near_dup
from strataframe.llm.components import components

SCHEMA = "doc_id long, text string, digest int, bands string, component_id long, label double"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", None, 0.5) for r in rows], SCHEMA)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((d, len(sets[i]), least, d == least))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, i = [], 0
    for _ in range(12):
        base = [word() for _ in range(rng.choice((6, 40, 200)))]
        for _ in range(rng.choice((1, 3, 9))):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = word()
            base = copy if rng.random() < 0.5 else base  # chains as well as stars
            rows.append((i * 3 % 101 - 9, " ".join(copy)))
            i += 1
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "A b"), (504, "a\x0bB "), (505, "a b\x1cc"), (506, "É é"), (507, "é É"), (508, "x " * 30_000), (None, "of no id at all here"), (None, "of no id at all here"), (509, "OF no id at all here"), (None, "alone without an id here")]
    rows += [rows[0], rows[0], (rows[1][0], "same id, another text altogether, yes")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    got = sorted((tuple(r) for r in near_dup.near_duplicates(frame(spark, rows).repartition(3)).collect()), key=repr)
    assert got == brute(rows)


def test_large_bucket_and_shuffled_fetch(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    monkeypatch.setattr(near_dup, "BROADCAST_IDS", 0)
    rng = random.Random(7)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(150)] = f"v{i}{rng.random()}"
        rows.append((i, " ".join(copy)))
    got = sorted((tuple(r) for r in near_dup.near_duplicates(frame(spark, rows)).collect()), key=repr)
    assert got == brute(rows)


def test_bands_follow_the_threshold():
    for percent in range(30, 100):
        n, rows = near_dup.layout(percent)
        assert n * rows <= near_dup.COORDINATES and (1 - (percent / 100) ** rows) ** n <= 1e-6
    assert near_dup.layout(85) == (32, 6) and near_dup.layout(80)[1] == 5


def test_lower_threshold(spark):
    rows = corpus(5)
    got = sorted((tuple(r) for r in near_dup.near_duplicates(frame(spark, rows), percent=60).collect()), key=repr)
    assert got == brute(rows, 60)


def test_empty(spark):
    assert near_dup.near_duplicates(frame(spark, [])).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        a = rng.integers(0, 2**63, 400).astype(np.uint64)
        b = np.concatenate([a[: rng.integers(100, 400)], rng.integers(0, 2**63, 100).astype(np.uint64)])
        true = len(set(a) & set(b)) / len(set(a) | set(b))
        errors.append(np.mean(near_dup.signature(a) == near_dup.signature(b)) - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB \t\n\x0b\x1c\xa0é", max_size=40))
def test_shingle_counts(text):
    assert len(near_dup.shingle_set(text)) == len(shingles(text))


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (102, 101), (7, 7), (None, 3), (101, 100)]
    got = dict(map(tuple, components(spark.createDataFrame([(f"{a:03d}" if a else None, f"{b:03d}") for a, b in links], "a string, b string")).collect()))
    assert got == {f"{i:03d}": "001" for i in range(1, 61)} | {f"{i:03d}": "100" for i in (100, 101, 102)}


@pytest.mark.parametrize(("part", "kind", "most_jobs"), [(100_000, "string", 20), (100_000, "long", 20), (40, "string", None)])
def test_components_take_few_jobs(spark, monkeypatch, part, kind, most_jobs):
    monkeypatch.setattr(comp, "PART", part, raising=False)
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(rng.randrange(2000, 4000), rng.randrange(2000, 4000)) for _ in range(1200)]
    rng.shuffle(links)
    least = {x: x for link in links for x in link}
    while any(least[a] != least[b] for a, b in links):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    name = (lambda x: f"{x:05d}") if kind == "string" else int
    sc = spark.sparkContext
    sc.setJobGroup(group := f"components-{part}-{kind}", "")
    try:
        got = dict(map(tuple, components(spark.createDataFrame([(name(a), name(b)) for a, b in links], f"a {kind}, b {kind}").repartition(5)).collect()))
        jobs = len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == {name(x): name(y) for x, y in least.items()}
    assert most_jobs is None or 0 < jobs <= most_jobs  # each is work for the driver, whose memory is small
