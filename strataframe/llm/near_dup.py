"""MinHash near-dedup with circulant signatures, banding and exact Jaccard verification.

A signature needs two permutations only: the first scatters shingle hashes over a ring of cells, the second is read at
every cell shifted by 0, 1, 2, ... places, one shift a coordinate. Documents with equal shingle sets form a class, and
only classes are banded. Classes that share a band are first compared with one centre of the bucket; those that are
still in different components afterwards are compared pair by pair, in blocks. Shingles that only one class has bound
the similarity that it can have with any other: what they rule out is not compared. Every link is confirmed on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import drop, materialize, remove, scratch_made, small_batches
from strataframe.llm.components import components

SHINGLE = 5
COORDINATES = 192
MISS = 1e-6  # share of pairs at the threshold that may have no band in common
RING = 1 << 21
BLOCK = 64
BROADCAST_IDS = 1_000_000
LOWEST = -(2**63)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text: A-Z lower-cased, words between ASCII white space.

    Fewer words than a shingle: one hash of them all; no words or null: none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(SHINGLE, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for j in range(size):
        total += _mix(words[j : len(words) - size + 1 + j]) * _ODD[j]
    return np.unique(_mix(total))


def layout(percent: int) -> tuple[int, int]:
    """(bands, coordinates a band): the longest bands that miss a pair at the threshold in MISS cases at most."""
    fits = [(COORDINATES // rows, rows) for rows in range(1, 7) if (1 - (percent / 100) ** rows) ** (COORDINATES // rows) <= MISS]
    return fits[-1] if fits else (COORDINATES, 1)


@lru_cache(1)
def _ring() -> np.ndarray:
    """Windows of the second permutation, written out twice around the ring: row c has what all shifts read at cell c."""
    order = np.random.default_rng(20_240_607).permutation(RING).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[:COORDINATES]]), COORDINATES)


def signature(hashes: np.ndarray) -> np.ndarray:
    """All coordinates of a set that is not empty."""
    cells = (_mix(hashes ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(64 - RING.bit_length() + 1)).astype(np.int64)
    out = np.full(COORDINATES, RING, np.uint32)
    for a in range(0, len(cells), 4096):
        np.minimum(out, _ring()[cells[a : a + 4096]].min(0), out=out)
    return out


def bands(hashes: np.ndarray, percent: int = 85) -> np.ndarray:
    """One 64-bit key a band; keys of different bands differ."""
    n, rows = layout(percent)
    sig = signature(hashes)[: n * rows].reshape(n, rows).astype(np.uint64)
    return _mix((_mix(sig + np.uint64(1)) * _ODD[:rows]).sum(1, dtype=np.uint64) + np.arange(n, dtype=np.uint64) * _ODD[0]).view(np.int64)


def digest(hashes: np.ndarray) -> str:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).hexdigest()


def _signer(percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingle_set(t) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "text_hash": frame["text_hash"], "n_shingles": [len(s) for s in sets], "digest": [digest(s) if len(s) else None for s in sets], "bands": [bands(s, percent) if len(s) else None for s in sets]})

    return run


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        sets = [shingle_set(t) for t in frame["text"]]
        yield pd.DataFrame({"digest": [digest(s) if len(s) else None for s in sets], "hashes": [s.view(np.int64) for s in sets]})


def _may_link(a: Column, b: Column, percent: int) -> Column:
    """Whether classes (n, common) can be similar enough: they share at most the lesser number of common shingles."""
    shared = F.least(a["common"], b["common"])
    return 100 * shared >= percent * (a["n"] + b["n"] - shared)


def _cross_links(percent: int) -> Column:
    """Array of the links (a, b) between two blocks of a bucket, left and right, across components.

    Members carry what they have beyond the bucket's centre (more) and lack of it (less), so the intersection of two of
    them is known exactly: what the centre has and neither lacks, and what both have beyond it. A pair that shares
    several bands is looked at in the least of them only.
    """

    def linked(x: Column, y: Column) -> Column:
        shared = F.col("centre_n") - F.size(F.array_union(x["less"], y["less"])) + F.size(F.array_intersect(x["more"], y["more"]))
        once = F.array_min(F.array_intersect(x["bands"], y["bands"])) == F.col("band")
        other = (x["label"] != y["label"]) & (~F.col("same") | (x["digest"] < y["digest"]))
        return other & _may_link(x, y, percent) & once & (100 * shared >= percent * (x["n"] + y["n"] - shared))

    pair = lambda x, y: F.struct(x["digest"].alias("a"), y["digest"].alias("b"))
    return F.flatten(F.transform("left", lambda x: F.transform(F.filter("right", lambda y: linked(x, y)), lambda y: pair(x, y))))


def _differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(digest, centre_digest, more, less) of pairs (digest, centre_digest): what the first set has beyond the second, and lacks."""
    left = pairs.join(sets.select("digest", F.col("hashes").alias("x")), "digest")
    both = left.join(sets.select(F.col("digest").alias("centre_digest"), F.col("hashes").alias("y")), "centre_digest")
    return both.select("digest", "centre_digest", F.array_except("x", "y").alias("more"), F.array_except("y", "x").alias("less"))


def common_shingles(sets: DataFrame) -> DataFrame:
    """(digest, n, common): size of each class's set, and how many of its shingles another class has too."""
    tagged = sets.select(F.xxhash64("digest").alias("tag"), F.explode("hashes").alias("shingle"))
    alone = tagged.groupBy("shingle").agg(F.count("*").alias("n"), F.min("tag").alias("tag")).where("n = 1").groupBy("tag").agg(F.count("*").alias("alone"))
    known = sets.select("digest", F.size("hashes").cast("long").alias("n"), F.xxhash64("digest").alias("of")).join(alone, F.col("of") == F.col("tag"), "left")
    return known.select("digest", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    left = pairs.join(sets.select(F.col("digest").alias("a"), F.col("hashes").alias("x")), "a")
    both = left.join(sets.select(F.col("digest").alias("b"), F.col("hashes").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    counted = both.select("a", "b", shared.alias("shared"), (F.size("x") + F.size("y")).alias("sizes"))
    return counted.where(100 * F.col("shared") >= percent * (F.col("sizes") - F.col("shared"))).select("a", "b")


def _fetch_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(digest, hashes) of the wanted classes, from the text of one document each."""
    picked = materialize(classes.join(wanted, "digest", "left_semi").select("fetch", "digest"), "dedup-wanted")
    ids = picked.select(F.col("fetch").alias("key"))
    near = F.broadcast(ids) if picked.count() <= BROADCAST_IDS else ids  # the same rows either way, of a checked size
    texts = docs.join(near, "key", "left_semi").select("text")
    found = texts.mapInPandas(_sets, "digest string, hashes array<long>")
    sets = materialize(found.join(picked, "digest", "left_semi").dropDuplicates(["digest"]), "dedup-sets")
    drop(picked)
    return sets


def _labelled(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows (doc_id, text_hash, n_shingles, digest), classes (digest, label, smallest)) of docs (doc_id, text), written."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(LOWEST)).alias("key"), "text")
    signed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInPandas(_signer(percent), "doc_id long, text_hash long, n_shingles long, digest string, bands array<long>")
    signed = materialize(signed, "dedup-signatures")
    member = signed.where("digest IS NOT NULL")
    classes = member.groupBy("digest").agg(F.min("doc_id").alias("least"), F.min(F.coalesce("doc_id", F.lit(LOWEST))).alias("fetch"), F.first("bands").alias("bands"))
    classes = materialize(classes, "dedup-classes")
    with scratch_made() as used:
        labels = _class_labels(docs, classes, percent)
        grouped = classes.select("digest", "least").join(labels.select(F.col("node").alias("digest"), "label"), "digest", "left").select("digest", "least", F.coalesce("label", "digest").alias("label"))
        smallest = grouped.groupBy("label").agg(F.min("least").alias("smallest"))
        found = materialize(grouped.join(smallest, "label").select(F.col("digest").alias("of"), "label", "smallest"), "dedup-components")
    remove(docs.sparkSession, classes.scratch_path, *(p for p in used if p != found.scratch_path))
    return signed.drop("bands"), found


def _class_labels(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(node, label): components of the classes that have links."""
    banded = classes.select(F.explode("bands").alias("band"), "digest")
    shared = banded.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    candidates = materialize(banded.join(shared, "band").select("band", "digest"), "dedup-hits")
    sets = _fetch_sets(docs, classes, candidates.select("digest").distinct())

    # a class whose own shingles alone keep it below the threshold has no link; the one with the fewest is the centre
    linkable = materialize(common_shingles(sets).where(100 * F.col("common") >= percent * F.col("n")), "dedup-linkable")
    hits = candidates.join(linkable, "digest")
    centres = hits.groupBy("band").agg(F.count("*").alias("size"), F.min(F.struct((F.col("n") - F.col("common")).alias("alone"), "digest", "n", "common")).alias("centre")).where("size > 1")
    hits = materialize(hits.join(centres, "band"), "dedup-hits")
    drop(candidates, linkable)
    star = hits.where((F.col("digest") != F.col("centre.digest")) & _may_link(F.struct("n", "common"), F.col("centre"), percent))
    star = star.select(F.least("digest", "centre.digest").alias("a"), F.greatest("digest", "centre.digest").alias("b")).distinct()
    links = materialize(confirmed(star, sets, percent), "dedup-links")
    labels = materialize(components(links), "dedup-labels")

    # what one centre left apart: all pairs of a bucket that are not yet in one component, in blocks
    labeled = hits.join(labels.select(F.col("node").alias("digest"), "label"), "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    labeled = labeled.select("band", "digest", "n", "common", "label", F.col("centre.digest").alias("centre_digest"), F.col("centre.n").alias("centre_n"))
    split = labeled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("band")
    apart = materialize(labeled.join(split, "band", "left_semi"), "dedup-apart")
    drop(hits, links)
    differences = materialize(_differences(apart.where("digest <> centre_digest").select("digest", "centre_digest").distinct(), sets), "dedup-differences")
    drop(sets)
    own_bands = apart.groupBy("digest").agg(F.collect_list("band").alias("bands"))
    empty = F.array().cast("array<long>")
    members = apart.join(own_bands, "digest").join(differences, ["digest", "centre_digest"], "left").withColumns({"more": F.coalesce("more", empty), "less": F.coalesce("less", empty)})
    more = materialize(_settled(members, percent), "dedup-links")
    drop(apart, differences)
    if more.isEmpty():
        return labels
    return components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))


def _settled(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of a band in different components, from blocks of about BLOCK members.

    A component with many members in a band has blocks of its own, which are not compared with each other; the members
    of all small ones are mixed. Every two blocks to be compared are a task's group of their own.
    """
    in_band = members.groupBy("band", "label").agg(F.count("*").alias("own"))
    small = in_band.groupBy("band").agg(F.coalesce(F.sum(F.when(F.col("own") < BLOCK, F.col("own"))), F.lit(0)).alias("mixed"))
    dealt = members.join(in_band.join(small, "band"), ["band", "label"])
    at = lambda hashed, n: F.pmod(F.xxhash64(hashed), F.ceil(n / BLOCK)).cast("string")
    own = F.concat(F.col("label"), F.lit("#"), at("digest", F.col("own")))
    dealt = dealt.withColumn("block", F.when(F.col("own") < BLOCK, at("label", F.col("mixed"))).otherwise(own))
    fields = ("digest", "n", "common", "label", "bands", "more", "less")
    blocks = materialize(dealt.groupBy("band", "centre_n", "block").agg(F.collect_list(F.struct(*fields)).alias("members"), F.min("label").alias("low"), F.max("label").alias("high")), "dedup-blocks")
    one, two = (blocks.select("band", F.col("block").alias(f"{s}_block"), F.col("low").alias(f"{s}_low"), F.col("high").alias(f"{s}_high")) for s in ("left", "right"))
    alike = F.expr("left_low = right_high AND left_high = right_low")  # one and the same component throughout
    twos = one.join(two, "band").where((F.col("left_block") <= F.col("right_block")) & ~alike).select("band", "left_block", "right_block")
    left, right = (blocks.select("band", F.col("block").alias(f"{s}_block"), F.col("members").alias(s), *["centre_n"] * (s == "left")) for s in ("left", "right"))
    met = twos.join(left, ["band", "left_block"]).join(right, ["band", "right_block"]).withColumn("same", F.col("left_block") == F.col("right_block"))
    return met.select(F.explode(_cross_links(percent)).alias("p")).select("p.a", "p.b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row a document.

    Documents are linked if their sets of distinct shingles have 100 * intersection >= percent * union; component_id
    is the smallest id that links reach, the document's own included. Null, empty and blank texts have no shingle and
    are linked with nothing. Every row is a document of its own: repeated rows have equal sets and so one component.
    A null id is never the smallest; a component of null ids only has a null component_id, and kept compares nulls as
    equal. An empty table gives no row. Other columns are not read.
    """
    signed, classes = _labelled(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), percent)
    out = signed.join(classes, F.col("digest") == F.col("of"), "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """docs with one row of each group of near duplicates: that with the smallest id (null last), then by text.

    Rows whose id and text are equal count as one, with the least of their other columns. Texts without a word stay,
    every row of them. The columns are those of docs.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    signed, classes = _labelled(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("r")
    stay = signed.join(classes, F.col("digest") == F.col("of")).groupBy("label").agg(first).select(F.coalesce("r.doc_id", F.lit(LOWEST)).alias("__key"), F.col("r.text_hash").alias("__hash"))
    worded = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.where(worded).withColumns({"__key": F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)), "__hash": F.xxhash64(text_col)})
    rest = [F.min(F.struct(*others)).alias("__others")] if others else []
    kept = keyed.join(stay, ["__key", "__hash"]).groupBy("__key", "__hash").agg(F.first(id_col).alias(id_col), F.first(text_col).alias(text_col), *rest)
    return kept.select(*[c if c in (id_col, text_col) else F.col(f"__others.`{c}`").alias(c) for c in docs.columns]).unionByName(docs.where(~worded))
