import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strataframe.llm import mixing

SCHEMA = "doc_id long, text string, source string, size long, target string, bucket int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def water_fill(sizes, weights, times=3):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > times * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: float(times * sizes[s]) for s in over}


def sample(n=400, hot="src0"):
    rng = random.Random(4)
    text = lambda: " ".join("w" * rng.randrange(1, 4) for _ in range(rng.choice((0, 1, 7, 60))))
    rows = [(i, text(), rng.choice((hot, hot, "src1", "src10", "é", "z", None))) for i in range(n)]
    return rows + [(1000, "long " * 5000, "tiny"), (1001, None, "void"), (1002, "a b\x0bc\x1cd", "one"), (1002, "a b", "one"), (None, "no id", "z"), (None, "no id", "z"), (7, "x", "")]


def test_words(spark):
    rows = sample()
    got = {(r.doc_id, r.text): r.n for r in frame(spark, rows).withColumn("n", mixing.word_count(F.col("text"))).collect()}
    assert got == {(i, t): len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}


@pytest.mark.parametrize("weights", [(5, 2, 1), (1,), (1, 50)])
def test_digest(spark, weights):
    rows = sample()
    got = mixing.mix_digest(frame(spark, rows), weights=weights).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(((r.doc_id, r.size) for r in got), key=repr) == sorted(((i, size(t)) for i, t, _ in rows), key=repr)
    sizes = {s: sum(size(t) for _, t, x in rows if x == s) for s in {r[2] for r in rows}}
    want = water_fill(sizes, weights)
    by_id = {}
    for i, t, s in rows:
        by_id.setdefault((i, size(t)), s)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = by_id[r.doc_id, r.size]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s]) and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
    again = mixing.mix_digest(frame(spark, rows[::-1]).repartition(7), weights=weights).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_schedule_is_even_and_ranked(spark):
    sizes = spark.createDataFrame([("a", 5000), ("b", 700), ("c", 9000), ("d", 3)], "source string, size long")
    targets = mixing.source_targets(sizes)
    quota = {r.place: -(-r.quota // 10) for r in targets.collect()}
    rows = sorted(map(tuple, mixing.schedule(targets, 10, chunk=64).collect()))
    n = len(rows)
    assert [r[0] for r in rows] == list(range(n)) and n == sum(quota.values())
    seen = dict.fromkeys(quota, 0)
    for slot, place, rank in rows:
        assert rank == seen[place]
        seen[place] += 1
        for p, q in quota.items():
            assert abs(seen[p] - (slot + 1) * q / n) <= 4
    assert seen == quota


def test_mix_covers_digest(spark):
    rows = sample(60)
    order = mixing.mix(frame(spark, rows)).collect()
    total = sum(r.taken for r in mixing.mix_digest(frame(spark, rows)).collect())
    assert sum(r.words for r in order) == total
    slots = {}
    for r in order:
        slots[r.slot] = slots.get(r.slot, 0) + r.words
    assert sorted(slots) == list(range(len(slots)))


def test_empty(spark):
    assert mixing.mix_digest(frame(spark, [])).count() == 0
    (r,) = mixing.mix_digest(frame(spark, [(1, None, None)])).collect()
    assert tuple(r) == (1, 0, 0, 0.0, 0, None, None, 0)


def test_repeated_rows_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 4)
    monkeypatch.setattr(mixing, "HEAVY", 2)
    rows = [(5, "a b c", "one")] * 30 + [(6, "d e", "one")] * 3 + [(7, "f g h i", "two"), (7, "x", "two")]
    got = mixing.mix_digest(frame(spark, rows)).collect()
    slots = Counter(r.slot for r in mixing.mix(frame(spark, rows)).collect())
    assert Counter(r.doc_id for r in got) == {5: 30, 6: 3, 7: 2} and sum(r.n_slots for r in got) == sum(slots.values())
    mixed = Counter((r.doc_id, r.text) for r in mixing.mixed_documents(frame(spark, rows), chars_col="none").collect())
    assert sum(len(t.split()) * n for (_, t), n in mixed.items()) == sum(r.taken for r in got)
    assert mixed[5, "a b c"] == sum(r.taken == 3 for r in got if r.doc_id == 5) > 20


def test_the_schedule_decides(spark, monkeypatch):
    """The digest's slots are those of t * g mod n by hand, and another step gives others."""
    rows = [(i, "w " * (1 + i % 9), f"s{i % 3}") for i in range(90)]
    got = mixing.mix_digest(frame(spark, rows)).collect()
    order = mixing.mix(frame(spark, rows)).collect()
    by_doc = {}
    for r in order:
        by_doc.setdefault(r.doc_id, []).append(r.slot)
    assert {r.doc_id: (r.first_slot, r.last_slot, r.n_slots) for r in got} == {i: (min(by_doc[i]), max(by_doc[i]), len(by_doc[i])) if i in by_doc else (None, None, 0) for i in range(90)}
    n = 1 + max(r.slot for r in order)
    step, slots_of = mixing.step_for(n), Counter()
    source = {r.slot: r.source for r in order}
    for s in source.values():
        slots_of[s] += 1
    cells = [s for s in sorted(slots_of) for _ in range(slots_of[s])]
    assert [source[t] for t in range(n)] == [cells[t * step % n] for t in range(n)]
    monkeypatch.setattr(mixing, "step_for", lambda slots: 1)
    assert sorted(map(repr, mixing.mix_digest(frame(spark, rows)).collect())) != sorted(map(repr, got))


def test_documents_come_in_the_order_of_the_schedule(spark):
    rows = [(i, f"w{i} " * (1 + i % 9), f"s{i % 3}") for i in range(200)]
    docs = frame(spark, rows)
    first = {}
    for r in mixing.mix(docs).collect():
        first[r.doc_id, r.epoch] = min(r.slot, first.get((r.doc_id, r.epoch), r.slot))
    times, at = Counter(), []
    for r in mixing.mixed_documents(docs, chars_col="none").collect():
        at.append(sorted(v for (i, _), v in first.items() if i == r.doc_id)[times[r.doc_id]])
        times[r.doc_id] += 1
    assert at == sorted(at) and len(at) == len(first)
