"""Places in groups of any size, and hashes of bundles, against plain loops."""

import hashlib
import random

from strataframe.operators import manifest


def test_numbered_counts_on_over_ranges(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else rng.choice(("a", "b", None)), rng.random(), i) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, k double, other int").repartition(5)
    got = {r.other: r.place for r in manifest.numbered(df, "g", ["k", "other"]).collect()}
    want = {}
    for g in ("hot", "a", "b", None):
        want |= {o: n for n, (_, o) in enumerate(sorted((k, o) for x, k, o in rows if x == g))}
    assert got == want and len(got) == 600
    assert manifest.numbered(df.limit(0), "g", ["k"]).count() == 0
    assert {(r.g, r.batch, len(r["keys"].split(","))) for r in manifest.batches(df.where("g = 'hot'"), "g", "other").collect()} == {("hot", b, 8) for b in range(50)}


def test_bundles_are_hashed_line_by_line(spark):
    rng = random.Random(3)
    rows = [(rng.choice((1, 2, None)), f"é{rng.randrange(50)}/x", rng.randrange(10**10)) for _ in range(300)]
    got = {r.bundle: r.hash for r in manifest.bundle_hash(spark.createDataFrame(rows, "bundle int, path string, size long").repartition(7), "bundle").collect()}
    want = {b: hashlib.sha256("".join(f"{p}\x00{s}\x00" for p, s in sorted((p, s) for x, p, s in rows if x == b)).encode()).hexdigest() for b in (1, 2, None)}
    assert got == want
