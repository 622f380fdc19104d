import itertools
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataframe.llm import pieces

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no vocabulary file")


@pytest.fixture(scope="module")
def v():
    return pieces.load()


@pytest.fixture(scope="module")
def reference_coder():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


WORDS = st.sampled_from(["the ", " and", "tion", "  ", "\n", "\t", "é", "中", "😀", "x", "aaaa", "0123", "́", "Thonre", "ß", " " * 9, "　", "​", "'s", "http://"])


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.one_of(st.text(max_size=30), st.lists(WORDS, max_size=12).map("".join)), max_size=5))
def test_equals_the_public_coder(v, reference_coder, texts):
    texts = [t.replace(pieces.MARK, "_").replace("\x00", "") for t in texts]
    got = pieces.encode_batch(v, texts)
    assert [x.tolist() for x in got] == [reference_coder.encode(t) for t in texts]
    assert [pieces.decode(v, ids) for ids in got] == texts


def test_long_words(v, reference_coder):
    rng = random.Random(1)
    texts = ["x" * 5000, " " * 300, "".join(rng.choice("abcdefghinorst") for _ in range(4000)), "ab" * 3000, "1" * 999]
    assert [x.tolist() for x in pieces.encode_batch(v, texts)] == [reference_coder.encode(t) for t in texts]


def test_shared_prefixes_are_searched_once(v, monkeypatch):
    ends = []
    own = pieces._extend_by_merges
    monkeypatch.setattr(pieces, "_extend_by_merges", lambda v, word, start, *rest: ends.extend(word[:e] for e in range(start + 1, len(word) + 1)) or own(v, word, start, *rest))
    pieces.encode_words(v, ["▁interest", "▁interesting", "▁interested", "▁in", "▁interesting"])
    assert len(ends) == len(set(ends)) == len("▁interesting") + 2


def test_unigram_is_the_best_path():
    rng = random.Random(2)
    known = {"".join(p) for n in (1, 2, 3) for p in itertools.product("ab", repeat=n)}
    scores = {p: -rng.random() * 9 for p in sorted(known)}
    v = pieces.Vocabulary(pieces.UNIGRAM, {p: i for i, p in enumerate(sorted(known))}, scores, [], 99, [p.encode() for p in sorted(known)])

    def best(word):
        cuts = [c for n in range(len(word)) for c in itertools.combinations(range(1, len(word)), n)] or [()]
        ways = [[word[a:b] for a, b in zip((0, *c), (*c, len(word)), strict=True)] for c in cuts]
        return max((sum(scores[p] for p in w), [v.ids[p] for p in w]) for w in ways if all(p in scores for p in w))

    words = ["".join(p) for n in range(1, 8) for p in itertools.product("ab", repeat=n)]
    for w, packed in pieces.encode_words(v, words).items():
        ids = np.frombuffer(packed, np.uint32).tolist()
        names = {i: p for p, i in v.ids.items()}
        assert sum(scores[names[i]] for i in ids) == pytest.approx(best(w)[0]) and "".join(names[i] for i in ids) == w


def test_documents(spark, v, reference_coder):
    rows = [(1, "Hello  world\n", "x", 5), (1, "Hello  world\n", "x", 5), (2, None, "y", 6), (3, "", None, 7), (None, "a▁b", "z", 8), (4, "long " * 30_000, "z", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = sorted(((r.doc_id, r.n_tokens, r.ids, r.decoded) for r in pieces.encode_documents(df, v).collect()), key=repr)
    want = [(i, len(reference_coder.encode(t)) if t else 0, None if t is None else reference_coder.encode(t), None if t is None else t.replace("▁", " ")) for i, t, _, _ in rows]
    assert got == sorted(want, key=repr)
    assert pieces.encode_documents(df.limit(0), v).count() == 0


def test_documents_with_a_unigram_vocabulary(spark):
    """Best paths over whole texts, word by word, by a table over all starts."""
    rng = random.Random(5)
    known = sorted({"".join(p) for n in (1, 2, 3) for p in itertools.product("ab▁", repeat=n)})
    scores = {p: -rng.random() * 9 for p in known}
    v = pieces.Vocabulary(pieces.UNIGRAM, {p: i for i, p in enumerate(known)}, scores, [], 99, [p.replace("▁", " ").encode() for p in known])
    texts = [" ".join("".join(rng.choices("ab", k=rng.randrange(1, 9))) for _ in range(rng.randrange(1, 9))) for _ in range(40)] + [None, "", "  a "]

    def best(word):
        ways = [(0.0, [])]
        for end in range(1, len(word) + 1):
            ways.append(max((ways[a][0] + scores[word[a:end]], [*ways[a][1], v.ids[word[a:end]]]) for a in range(max(0, end - 3), end)))
        return ways[-1]

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pieces.encode_documents(df, v).collect():
        text = texts[r.doc_id]
        assert r.decoded == text and (r.ids is None) == (text is None)
        if text:
            names = {i: p for p, i in v.ids.items()}
            assert sum(scores[names[i]] for i in r.ids) == pytest.approx(sum(best(w)[0] for w in pieces.marked(v, text)))


def test_missing_vocabulary():
    with pytest.raises(FileNotFoundError, match="on the driver"):
        pieces.load("/no/such.model")


def test_small_cache(v, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 2)
    monkeypatch.setattr(pieces, "CACHE_PAIRS", 3)
    texts = ["one two three", "four five", "one six"]
    assert [pieces.encode_batch(v, [t])[0].tolist() for t in texts] == [x.tolist() for x in pieces.encode_batch(pieces.load(), texts)]


def test_a_smaller_share_gives_the_same(v, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcdeinrst", k=rng.randrange(1, 9))) for _ in range(200)) for _ in range(30)]
    small = pieces.load(share=1e-4)
    assert [x.tolist() for t in texts for x in pieces.encode_batch(small, [t])] == [x.tolist() for x in pieces.encode_batch(v, texts)]
    assert len(small.words) < 500 and len(small.pairs) <= 50
