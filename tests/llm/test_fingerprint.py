import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strataframe.llm import fingerprint as fp

SCHEMA = "doc_id long, text string, sketch int, next_text string, lang string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", None) for i, t in rows], SCHEMA)


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_matches_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdéß") for _ in range(3))
    rows = [(i * 7 - 30, " ".join(word() for _ in range(rng.choice((0, 1, 4, 5, 30, 400))))) for i in range(60)]
    rows += [(None, "of no id"), (5000, None), (9000, "long " * 9000 + "\x00\t\n tail"), (9001, ""), (9002, "ab"), (9003, "😀é" * 9)]
    rng.shuffle(rows)
    for per_range in (3, 2000):
        got = {r.doc_id: r for r in _run(spark, rows, per_range, monkeypatch).collect()}
        order = sorted(rows, key=lambda r: -(r[0] if r[0] is not None else fp.LOWEST))
        assert len(got) == len(rows)
        for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
            text, after = text or "", after or ""
            half = len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            for other, near in ((edited, got[i].near_edited), (after, got[i].near_next)):
                a, b = shingles(text), shingles(other)
                true = len(a & b) / len(a | b) if a | b else 1.0
                assert near == (pytest.approx(true, abs=1e-9) if len(a) < fp.K and len(b) < fp.K else pytest.approx(true, abs=0.17))


def _run(spark, rows, per_range, monkeypatch):
    own = fp.in_ranges
    monkeypatch.setattr(fp, "in_ranges", lambda d, c: own(d, c, per_range))
    out = fp.fingerprint_edits(frame(spark, rows))
    monkeypatch.setattr(fp, "in_ranges", own)
    return out


def test_small_tables(spark):
    assert fp.fingerprint_edits(frame(spark, [])).count() == 0
    (r,) = fp.fingerprint_edits(frame(spark, [(4, "abcd")])).collect()
    assert (r.edited_sha256, r.near_next) == (hashlib.sha256(b"abab").hexdigest(), 1.0)
    twice = fp.fingerprint_edits(frame(spark, [(4, "a b c d e f")] * 3 + [(None, None)] * 2)).collect()
    assert len(twice) == 5 and len({r.fingerprint for r in twice if r.doc_id == 4}) == 1


def test_merge_counts_and_containment(spark):
    words = [f"w{i}" for i in range(3000)]
    rows = [(0, " ".join(words)), (1, " ".join(words[:1500])), (2, " ".join(words[1496:])), (3, "")]
    s = {r.doc_id: r.s for r in fp.with_sketch(frame(spark, rows), "text", "s").select("doc_id", "s").collect()}
    df = spark.createDataFrame([(s[0], s[1], s[2], s[3])], "a array<long>, b array<long>, c array<long>, e array<long>")
    a, b, c, e = (F.col(x) for x in "abce")
    r = df.select(fp.merge(b, c).alias("m"), fp.distinct_count(a), fp.containment(b, a), fp.containment(a, b), fp.resemblance(e, e), fp.resemblance(a, e)).first()
    assert r[0] == s[0] and r[1] == pytest.approx(2996, rel=0.3) and r[2] > 0.85 and r[3] == pytest.approx(0.5, abs=0.15) and tuple(r[4:]) == (1.0, 0.0)


def test_merge_by_group(spark):
    rows = [(i, " ".join(f"x{(i * 13 + j) % 900}" for j in range(40))) for i in range(300)]
    df = fp.with_sketch(frame(spark, rows), "text", "s").withColumn("g", F.when(F.col("doc_id") < 290, "hot").otherwise(F.lit(None)))
    got = {r.g: r.s for r in fp.merge_by(df, ["g"], "s", fan_in=5).collect()}
    every = {r.doc_id: r.s for r in df.collect()}
    assert got["hot"] == sorted({h for i in range(290) for h in every[i]})[: fp.K]
    assert got[None] == sorted({h for i in range(290, 300) for h in every[i]})[: fp.K]
