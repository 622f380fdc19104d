import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.llm import language as la

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score int, lang_pred string, rejected string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", None) for r in rows], SCHEMA)


def corpus(n=240):
    rng = random.Random(1)
    syllables = {"aa": "ka lo mi te ru".split(), "bb": "sch ung öp ß eit".split(), "cc": "ция ост ный".split()}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(syllables))
        words = ["".join(rng.choices(syllables[lang], k=rng.randrange(1, 4))) for _ in range(rng.choice((3, 40)))]
        rows.append((i, " ".join(words), lang if i % 9 else None))
    return rows


def test_learns_and_rejects(spark):
    rows = corpus()
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !? \n", "bb"), (1003, "kalomi " * 40_000, None), (None, "ungung schung", None), (1004, "kalo", "aa"), (1004, "kalo", "aa")]
    df = frame(spark, rows + odd)
    model = la.fit(df)
    assert model.languages == ["aa", "bb", "cc"] and 0 <= model.reject_below <= 0.5
    got = la.predict(df, model).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows + odd)
    truth = {i: max("aa bb cc".split(), key=lambda k: sum(s in t for s in {"aa": ("ka", "lo", "mi", "te", "ru"), "bb": ("sch", "ung", "öp", "ß", "eit"), "cc": ("ция", "ост", "ный")}[k])) for i, t, _ in rows}
    assert np.mean([by_id[i].lang_pred == truth[i] for i in truth]) > 0.97
    for i in (1000, 1001, 1002):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[1003].lang_pred == "aa" and by_id[None].lang_pred == "bb" and all(0 <= r.score <= 1 for r in got)
    assert sorted((r.doc_id, r.held) for r in df.select("doc_id", la.held_out(df.doc_id).alias("held")).where("doc_id >= 0").collect()) == sorted((i, zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows + odd if i is not None)


def test_same_rows_same_model(spark):
    rows = corpus(80)
    a, b = la.fit(frame(spark, rows)), la.fit(frame(spark, rows[::-1]).repartition(5))
    assert np.array_equal(a.embeddings, b.embeddings) and a.temperature == b.temperature


def test_held_out_rows_are_not_learned(spark):
    rows = corpus(120)
    held = [(i, t, "never") for i, t, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and "never" not in la.fit(frame(spark, [r for r in rows if r[0] not in {h[0] for h in held}] + held)).languages


def test_no_labels_and_empty(spark):
    df = frame(spark, [(1, "kalo", None)])
    (r,) = la.predict(df, la.fit(df)).collect()
    assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    assert la.predict(df.limit(0), la.fit(df.limit(0))).count() == 0
    one = frame(spark, [(1, "kalo", "aa"), (3, "zz", None)])
    assert {r.lang_pred for r in la.predict(one, la.fit(one)).collect()} == {"aa"}


def test_long_texts_are_learned_in_part(spark):
    rows = [(i, " ".join(random.Random(i).choices("ka lo mi te ru".split(), k=9)), "aa") for i in range(40)]
    rows += [(100 + i, "12 " * 9_000 + "schungöp eit " * 3_000, "bb") for i in range(8)]
    model = la.fit(frame(spark, rows))
    assert model.languages == ["aa", "bb"] and model.predict("schungöp eit")[0] == "bb"


def by_hand(model, text):
    """The forward pass over a dictionary of the n-grams of each word, one at a time."""
    words, word = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            words.append(word)
            word = ""
    total, n = np.zeros(la.DIM), 0
    for w in words:
        marked = [0, *map(ord, w), 0]
        for size in la.NGRAMS:
            for i in range(len(marked) - size + 1):
                gram = marked[i : i + size]
                if size == 1 and gram == [0]:
                    continue
                h = size
                for code in gram:
                    h = (h ^ code) * 0x9E3779B97F4A7C15 % 2**64
                    h ^= h >> 29
                total += model.embeddings[h >> 48]
                n += 1
    if not n or not model.languages:
        return "und", 0.0
    z = [(float(w @ (total / n)) + b) / model.temperature for w, b in zip(model.weights, model.bias, strict=True)]
    p = np.exp(np.array(z) - max(z))
    return model.languages[int(np.argmax(p))], float(p.max() / p.sum())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_predictions_by_hand(spark):
    docs = spark.read.parquet(f"{SF.replace('0.01', '0.001')}/documents.parquet")
    model = la.fit(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in la.predict(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(texts) == 200
    for i, t in texts.items():
        lang, score = by_hand(model, t or "")
        assert got[i][0] == lang and got[i][1] == pytest.approx(score, abs=1e-5)


def test_subwords():
    assert len(la.subwords("")) == len(la.subwords("12 !")) == 0
    assert sorted(la.subwords("Ab, ab!")) == sorted(np.concatenate([la.subwords("ab")] * 2))
    assert len(la.subwords("ab")) == 2 + 3 + 2 + 1  # a b; _a ab b_; _ab ab_; _ab_
    assert sorted(la.subwords(" x  y")) == sorted(np.concatenate([la.subwords("x"), la.subwords("y")]))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = la.predict(docs, la.fit(docs), keep=("doc_id", "lang")).where(la.held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.col("score") > 0))
    rows = found.collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    sure = [r for r in rows if r.score > 0.9]
    assert np.mean([r.lang == r.lang_pred for r in sure]) > 0.99 and np.mean([r.rejected for r in rows]) < 0.02
