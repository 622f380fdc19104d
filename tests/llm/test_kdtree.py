import math
import random

import numpy as np
import pytest

from strataframe.llm import kdtree


def brute(rows, asked, k):
    rows = sorted((i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v))
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    out = []
    for at, (i, q) in enumerate(rows):
        if asked(i):
            score = lambda v: min(2**63 - 1, max(-(2**63), sum(a * b for a, b in zip(q, v, strict=True))))  # noqa: B023, E731
            best = sorted((-score(v), j) for n, (j, v) in enumerate(rows) if n != at and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def run(spark, rows, k=5, **sizes):
    df = spark.createDataFrame([(i, v, 3, 1.0, 2) for i, v in rows], "vec_id long, embedding array<float>, shard int, score double, rank int")
    v = df.select("vec_id", kdtree.scaled(df.embedding).alias("v"))
    return sorted(map(tuple, kdtree.search_all(v, v.where("vec_id % 50 = 0"), k, **sizes).collect()))


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 60, "block_rows": 3}])
def test_equals_brute_force(spark, monkeypatch, sizes):
    rng = random.Random(2)
    monkeypatch.setattr(kdtree.build, "__defaults__", (None, 8))
    monkeypatch.setattr(kdtree, "SAMPLE", 64)
    rows = [(i, [rng.choice((-1.0, 0.5, 0.251, rng.gauss(0, 0.3))) for _ in range(6)]) for i in range(-20, 350)]
    rows += [(i, [0.5] * 6) for i in range(400, 520)]  # a very common vector: ties
    rows += [(600, None), (650, [0.1, None] + [0.0] * 4), (700, [float("nan")] * 6), (750, [float("inf")] * 6), (800, [1.0, 2.0]), (801, [2.0, -1.0]), (850, []), (900, [0.9] * 7)]
    rows += [rows[30], rows[30], (None, [0.5] * 6), (50, [0.25] * 6), rows[20], rows[70], rows[70], (1050, [3e37, 1.0, -2.0, 0.0, 1e30, 0.5]), (1051, [1e37, -1.0, 1.0, 0.0, 1.0, 0.5])]
    assert run(spark, rows, **sizes) == brute(rows, lambda i: i % 50 == 0, 5)


def test_empty_and_few(spark):
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (7, [-1.0])]) == [(0, 1, 7, -65536)]


def test_shards_are_parts_of_space_and_skipped(spark, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(kdtree, "SAMPLE", 256)
    at = rng.integers(0, 8, 600)
    points = (at[:, None] * 3.0 + rng.normal(0, 0.2, (600, 3))).astype(np.float32)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    assert run(spark, rows, shard_rows=50) == brute(rows, lambda i: i % 50 == 0, 5)
    whole = np.floor(points.astype(float) * 256)
    tree = kdtree.splits(whole, 8)
    leaf = kdtree.leaf_of(whole, tree)
    assert len(tree) == 7 and set(leaf) <= set(range(8)) and np.bincount(leaf, minlength=8).max() < 150
    boxes = [(whole[leaf == x].min(0), whole[leaf == x].max(0)) for x in sorted(set(leaf))]
    frames = (kdtree.pd.DataFrame({"leaf": range(len(boxes)), "part": 0, "low": [a for a, _ in boxes], "high": [b for _, b in boxes]}), kdtree.pd.DataFrame({"dim": 3, "vec_id": 1, "query_key": 1, "v": [list(whole[at == 7][0])], "leaf": 99, "part": 0, "block": 0, "kth": [int(np.sort(whole @ whole[at == 7][0])[-6])]}))
    assert 0 < len(kdtree._reachable(*frames)) < len(boxes) // 2


def test_hot_vector_and_splits():
    same = np.ones((50, 2))
    assert set(kdtree.leaf_of(same, kdtree.splits(same, 4))) == {3}
    mixed = np.concatenate([same, np.arange(20).reshape(10, 2) * 2.0])
    leaf = kdtree.leaf_of(mixed, kdtree.splits(mixed, 4))
    assert len({tuple(mixed[leaf == x][:, 0]) for x in set(leaf)}) == len(set(leaf)) > 1 and kdtree.splits(mixed, 1) == []


def test_large_components_are_exact():
    big = np.array([[2**30, 1], [2**30, 0], [-(2**30), 5]], dtype=np.int64)
    tree = kdtree.build(big, np.array([4, 5, 6]), leaf=1)
    ((_, ids, scores, _),) = kdtree.search(tree, big[:1], np.array([4]), [None], 2)
    assert list(ids) == [5, 6] and list(scores) == [2**60, -(2**60) + 5]


def test_pruning_skips_boxes(monkeypatch):
    rng = np.random.default_rng(0)
    points = rng.integers(-1000, 1000, (5000, 2))
    tree = kdtree.build(points, np.arange(5000), leaf=16)
    seen = []
    pop = kdtree.heapq.heappop
    monkeypatch.setattr(kdtree.heapq, "heappop", lambda h: seen.append(1) or pop(h))
    list(kdtree.search(tree, points[:1], np.array([0]), [None], 5))
    assert len(seen) < 100
