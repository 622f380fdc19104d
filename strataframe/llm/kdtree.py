"""Exact top-k inner product search with one KD-tree per shard.

Shards are parts of space: the leaves of a tree of median splits over a sample, and where a leaf holds too many rows,
parts of it by hash, so no vector or id, however frequent, makes a shard large. A shard's tree splits at the median of
its widest dimension and keeps the tight box of every node; a query visits nodes best first, by the most that a point
in the box can score, and stops at a box that cannot reach its kth score. The kth score of each query's own shard goes
with it; only shards whose box can reach it are searched.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.llm.common import materialize, small_batches

LEAF = 256
SAMPLE = 32_768  # rows that the splits between shards are taken from, and shards compared with a block of queries at once
SPLIT_DIMS = 16  # lengths of vectors, the most frequent, whose shards are parts of space
LONG = 2**63
HITS = "query_id long, query_key long, vec_id long, score long, times long"
ASKED = "dim int, vec_id long, query_key long, v array<double>, leaf int, part int, block int, kth long"


@dataclass
class Tree:
    """points, ids and times in leaf order; node i has points start[i] to end[i] and children left, right."""

    points: np.ndarray
    ids: np.ndarray
    times: np.ndarray
    low: np.ndarray
    high: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray


def build(points: np.ndarray, ids: np.ndarray, times: np.ndarray | None = None, leaf: int = LEAF) -> Tree:
    """Tree over points of whole numbers; times: how often each is there, once without. Of equal points a leaf may hold any number."""
    order = np.argsort(ids, kind="stable")
    low, high, start, end, left, right = [], [], [], [], [], []
    todo = [(0, len(order), -1, False)]
    while todo:
        a, b, parent, is_right = todo.pop()
        node, part = len(low), points[order[a:b]]
        if parent >= 0:
            (right if is_right else left)[parent] = node
        low.append(part.min(0) if b > a else np.zeros(points.shape[1], points.dtype))
        high.append(part.max(0) if b > a else np.zeros(points.shape[1], points.dtype))
        start.append(a), end.append(b), left.append(-1), right.append(-1)
        if b - a <= leaf or not points.shape[1]:
            continue
        axis = int(np.argmax(high[-1] - low[-1]))
        if high[-1][axis] == low[-1][axis]:
            continue
        mid = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(part[:, axis], mid)]
        todo += [(a, a + mid, node, False), (a + mid, b, node, True)]
    times = np.ones(len(ids), np.int64) if times is None else times
    return Tree(points[order], ids[order], times[order], np.array(low), np.array(high), *(np.array(x, dtype=np.int64) for x in (start, end, left, right)))


_whole = np.frompyfunc(int, 1, 1)


def _exact(points: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """The arrays as float64 where all products and sums of the first two are exact in it, else as Python integers."""
    most = [float(np.abs(x).max()) if x.size else 0.0 for x in (points, others[0])]
    if most[0] * most[1] * max(1, points.shape[1]) < 2**53:
        return [x.astype(np.float64) for x in (points, *others)]
    return [_whole(x) if x.size else x.astype(object) for x in (points, *others)]


def _bounds(asked: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The most that a point of each box can score for each query, as scores are told: within the range of long."""
    zero = asked * 0
    most = np.maximum(asked, zero) @ high.T + np.minimum(asked, zero) @ low.T
    return np.clip(most, -LONG, LONG - 1) if most.dtype == object else most


def search(tree: Tree, queries: np.ndarray, own: np.ndarray, kth: list[int | None], k: int) -> Iterator[tuple]:
    """(query index, ids, scores, times) of each query's k best points, best first and ties to the smaller id.

    own: the queries' ids; of a point with a query's id and vector one row is the query itself. kth: scores that other
    rows have reached k times already, or None; points below are left out. Scores end at the range of long.
    """
    points, asked, low, high = _exact(tree.points, queries, tree.low, tree.high)
    bounds = _bounds(asked, low, high)
    for i, q in enumerate(asked):
        floor = kth[i]
        best_ids, best, best_times = np.empty(0, np.int64), np.empty(0, points.dtype), np.empty(0, np.int64)
        heap = [(-bounds[i, 0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if floor is not None and -bound < floor:
                break
            if tree.left[node] >= 0:
                for child in (tree.left[node], tree.right[node]):
                    if floor is None or bounds[i, child] >= floor:
                        heapq.heappush(heap, (-bounds[i, child], int(child)))
                continue
            a, b = tree.start[node], tree.end[node]
            ids, scores, times = tree.ids[a:b], points[a:b] @ q, tree.times[a:b]
            if points.dtype == object:
                scores = np.clip(scores, -LONG, LONG - 1)
            keep = np.ones(b - a, bool) if floor is None else (scores >= floor).astype(bool)
            for j in np.flatnonzero(ids == own[i]):
                if np.array_equal(tree.points[a + j], queries[i]):
                    times = times.copy()
                    times[j] -= 1
                    keep[j] &= times[j] > 0
            if not keep.any():
                continue
            ids, scores, times = np.concatenate([best_ids, ids[keep]]), np.concatenate([best, scores[keep]]), np.concatenate([best_times, times[keep]])
            first = np.array(sorted(range(len(ids)), key=lambda x: (-scores[x], ids[x]))[:k]) if scores.dtype == object else np.lexsort((ids, -scores))[:k]
            best_ids, best, best_times = ids[first], scores[first], times[first]
            if len(best) == k:
                floor = best[-1] if floor is None else max(floor, best[-1])
        yield i, best_ids, best, best_times


def splits(points: np.ndarray, leaves: int) -> list[tuple[int, float]]:
    """(axis, value) of the median splits of a full binary tree with at least so many leaves, level by level.

    The children of split i are 2i + 1, for points below the value, and 2i + 2; where a part is all one point its
    splits send everything to the second child.
    """
    out, parts = [], [points]
    for _ in range(max(0, leaves - 1).bit_length()):
        after = []
        for part in parts:
            wide = part.max(0) - part.min(0) if len(part) and part.shape[1] else np.zeros(1)
            axis = int(wide.argmax())
            if not wide[axis] > 0:
                out.append((0, -np.inf))
                after += [part[:0], part]
                continue
            cut = float(np.partition(part[:, axis], len(part) // 2)[len(part) // 2])
            if cut == part[:, axis].min():  # more than half lie at the lowest value: all of it goes to the first child
                cut = float(part[:, axis][part[:, axis] > cut].min())
            out.append((axis, cut))
            after += [part[part[:, axis] < cut], part[part[:, axis] >= cut]]
        parts = after
    return out


def leaf_of(points: np.ndarray, tree: list[tuple[int, float]]) -> np.ndarray:
    """The leaf of each point, from 0, in a tree of splits()."""
    at = np.zeros(len(points), np.int64)
    if tree:
        axes, cuts = np.array([a for a, _ in tree]), np.array([c for _, c in tree])
        for _ in range(len(tree).bit_length()):
            at = 2 * at + 1 + (points[np.arange(len(points)), axes[at]] >= cuts[at])
    return at - len(tree)


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64).reshape(len(vectors), dim)


def _located(rows: DataFrame, trees: dict[int, list[tuple[int, float]]]) -> DataFrame:
    """rows with leaf; those of a length without splits have leaf 0."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            leaf = np.zeros(len(frame), np.int32)
            for dim, tree in trees.items():
                here = (frame["dim"] == dim).to_numpy()
                if here.any():
                    leaf[here] = leaf_of(_matrix(frame.loc[here, "v"], dim), tree)
            yield frame.assign(leaf=leaf)

    if not any(trees.values()):
        return rows.withColumn("leaf", F.lit(0))
    small_batches(rows.sparkSession, 10_000)
    return rows.mapInPandas(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields) + ", leaf int")


def _index(frame: pd.DataFrame) -> pd.DataFrame:
    dim = int(frame["dim"].iloc[0])
    tree = build(_matrix(frame["v"], dim), frame["vec_id"].to_numpy(np.int64), frame["times"].to_numpy(np.int64))
    low, high = [tree.low[0]], [tree.high[0]]
    if tree.points.size and np.abs(tree.points).max() < 2**15:
        tree.points, tree.low, tree.high = (x.astype(np.int16) for x in (tree.points, tree.low, tree.high))
    return pd.DataFrame({"dim": [dim], "leaf": frame["leaf"].iloc[:1].to_numpy(), "part": frame["part"].iloc[:1].to_numpy(), "low": low, "high": high, "tree": [pickle.dumps(tree, protocol=5)]})


def _searcher(k: int):
    def run(trees: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(trees) and len(asked):
            tree: Tree = pickle.loads(trees["tree"].iloc[0])
            queries = _matrix(asked["v"], tree.points.shape[1])
            own, keys = asked["vec_id"].to_numpy(np.int64), asked["query_key"].to_numpy(np.int64)
            kth = [None if pd.isna(x) else int(x) for x in asked["kth"]]
            for a in range(0, len(asked), 512):
                for i, *found in search(tree, queries[a : a + 512], own[a : a + 512], kth[a : a + 512], k):
                    out += [(own[a + i], keys[a + i], int(p), int(s), int(t)) for p, s, t in zip(*found, strict=True)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in HITS.split(", ")]).astype("int64")

    return run


def _reachable(boxes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """A row of asked for each box, other than its own, that can reach the query's kth score."""
    out = []
    if len(boxes) and len(asked):
        dim = int(asked["dim"].iloc[0])
        queries, low, high = _exact(_matrix(asked["v"], dim), _matrix(boxes["low"], dim), _matrix(boxes["high"], dim))
        same = (asked["leaf"].to_numpy()[:, None] == boxes["leaf"].to_numpy()) & (asked["part"].to_numpy()[:, None] == boxes["part"].to_numpy())
        kth = asked["kth"].astype(object).where(asked["kth"].notna(), -LONG).to_numpy()[:, None]
        reach = (_bounds(queries, low, high) >= kth).astype(bool) & ~same
        for b in np.flatnonzero(reach.any(0)):
            out.append(asked[reach[:, b]].assign(leaf=boxes["leaf"].iloc[b], part=boxes["part"].iloc[b]))
    names = [c.split()[0] for c in ASKED.split(", ")]
    return (pd.concat(out) if out else asked.iloc[:0])[names].astype({"kth": "Int64"})


def scaled(vector: Column) -> Column:
    """floor(256 * x) of each component x, exactly, as whole doubles; null for a vector that is null or has a null or non-finite component."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = lambda y: F.when(F.abs(y) < float(2**53), F.floor(y).cast("double")).otherwise(y)
    return F.when(ok, F.transform(vector, lambda x: whole(x.cast("double") * 256)))


def _splits_by_dim(vectors: DataFrame, shard_rows: int) -> dict[int, list[tuple[int, float]]]:
    """Splits for the lengths that need several shards, from a sample of about SAMPLE rows of each by hash."""
    large = vectors.groupBy("dim").count().where(F.col("count") > shard_rows).orderBy(F.desc("count"), "dim").limit(SPLIT_DIMS).collect()
    out = {}
    for dim, n in large:
        draw = F.pmod(F.xxhash64("v", "vec_id"), F.lit(max(1, n // SAMPLE))) == 0
        rows = vectors.where((F.col("dim") == dim) & draw).select("v").limit(4 * SAMPLE).toArrow()["v"]
        out[dim] = splits(_matrix(rows.to_pandas(), dim), min(SAMPLE // 8, -(-n // shard_rows))) if dim else []
    return out


def search_all(vectors: DataFrame, queries: DataFrame, k: int, shard_rows: int = 16_384, block_rows: int = 4_096) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries the k best rows of vectors, both (vec_id long, v array<double>).

    v holds whole numbers, as scaled() makes them. queries are rows of vectors, and every row but the query's own is a
    candidate: rows that repeat, those of the query included, take as many places as there are, and a repeated query is
    answered as often. Scores are exact and end at the range of long. Queries without id or vector and vectors without
    take no part; vectors of another length than the query's are no candidates of it. Fewer than k candidates: all of
    them. An empty table gives no row; other columns are not read.
    """
    clean = lambda df: df.where("vec_id IS NOT NULL AND v IS NOT NULL").groupBy("vec_id", "v", F.size("v").alias("dim")).agg(F.count("*").alias("times"))
    vectors = materialize(clean(vectors), "kdtree-rows")
    trees = _splits_by_dim(vectors, shard_rows)
    queries = clean(queries).withColumn("query_key", F.xxhash64("v"))
    asked_rows = materialize(queries, "kdtree-asked")
    largest = asked_rows.groupBy("dim").count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, -(-largest // block_rows))

    placed = materialize(_located(vectors, trees), "kdtree-placed")
    sizes = placed.groupBy("dim", "leaf").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("int").alias("part")
    index = placed.join(sizes, ["dim", "leaf"]).select("dim", "leaf", part, "vec_id", "v", "times").groupBy("dim", "leaf", "part")
    index = materialize(index.applyInPandas(_index, "dim int, leaf int, part int, low array<double>, high array<double>, tree binary"), "kdtree")
    located = _located(asked_rows.select("vec_id", "v", "dim", "query_key"), trees).join(sizes, ["dim", "leaf"], "left")
    home = F.pmod(F.xxhash64("vec_id", "v"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")
    block = F.pmod(F.xxhash64("vec_id", "query_key"), F.lit(blocks)).cast("int").alias("block")
    asked = materialize(located.select("dim", "vec_id", "query_key", "v", "leaf", home, block, F.lit(None).cast("long").alias("kth")), "kdtree-queries")

    def found(asked: DataFrame) -> DataFrame:
        """Each shard that is asked meets a block of its queries, in a task's group."""
        by = ["dim", "leaf", "part", "block"]
        wanted = asked.select(*[F.col(c).alias(c) for c in by]).distinct()
        return index.drop("low", "high").join(wanted, by[:3]).groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(_searcher(k), HITS)

    first = materialize(found(asked), "kdtree-home")
    reached = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    kth = first.withColumn("upto", F.sum("times").over(reached)).where(F.col("upto") >= k).groupBy("query_id", "query_key").agg(F.max("score").alias("kth"))
    bounded = asked.drop("kth").join(kth.select(F.col("query_id").alias("vec_id"), "query_key", "kth"), ["vec_id", "query_key"], "left")
    batches = max(1, -(-index.count() // SAMPLE))
    boxes = index.select("dim", "leaf", "part", "low", "high", F.pmod(F.xxhash64("leaf", "part"), F.lit(batches)).cast("int").alias("batch"))
    boxes = boxes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    bounded = bounded.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    by = ["dim", "block", "batch"]
    others = materialize(boxes.groupBy(*by).cogroup(bounded.groupBy(*by)).applyInPandas(_reachable, ASKED), "kdtree-reachable")
    hits = first.unionByName(found(others))
    one = F.struct((-F.col("score").cast("decimal(20,0)")).alias("minus"), "vec_id", "times")
    best = hits.groupBy("query_id", "query_key").agg(F.slice(F.sort_array(F.collect_list(one)), 1, k).alias("best"))
    rows = F.slice(F.flatten(F.transform("best", lambda b: F.array_repeat(b, F.least(b["times"], F.lit(k)).cast("int")))), 1, k)
    answers = asked_rows.select(F.col("vec_id").alias("query_id"), "query_key", F.sequence(F.lit(1).cast("long"), "times").alias("copies")).withColumn("copy", F.explode("copies"))
    best = best.select("query_id", "query_key", rows.alias("best")).join(answers.drop("copies"), ["query_id", "query_key"])
    return best.select("query_id", F.posexplode("best").alias("at", "hit")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).cast("long").alias("score"))
