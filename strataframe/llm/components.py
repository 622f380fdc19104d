"""Connected components of a table of links: contracted part by part, then by alternating large-star and small-star steps.

Each round of steps is a dozen shuffles and broadcasts that the driver plans and keeps account of. Links that fit one part
need none, and of the others each part leaves a tie a node.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import drop, materialize

#: Nodes with more than this part of all rows are heavy: fewer than so many can be, and their least goes to every task.
HEAVY = 256
#: Links that a worker looks at together; each is held as two nodes.
PART = 100_000


def _contracted(part: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ties (u, v), u > v, of each node to the least that a task's links reach from it, of about 2 * part nodes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}

        def root(x):
            while (y := up[x]) != x:
                up[x] = x = up[y]
            return x

        def ties(schema: pa.Schema) -> pa.RecordBatch:
            found = [(x, r) for x in up if (r := root(x)) != x]
            up.clear()
            return pa.RecordBatch.from_arrays([pa.array([t[k] for t in found], schema.field(k).type) for k in (0, 1)], names=["u", "v"])

        batch = None
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                up.setdefault(a, a)
                up.setdefault(b, b)
                a, b = root(a), root(b)
                if a != b:
                    up[max(a, b)] = min(a, b)
            if len(up) > 2 * part:
                yield ties(batch.schema)
        if up:
            yield ties(batch.schema)

    return run


def _star(pairs: DataFrame, large: bool, rows: int) -> DataFrame:
    """pairs (u, v), u > v. Large: each node ties its larger neighbours to the least of its neighbourhood; small: the others.

    rows: how many pairs there are, or more. The least of a heavy node is broadcast and its ties are dealt by their other end.
    """
    ties = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else pairs
    least = ties.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), (F.col("n") * HEAVY > rows * (1 + large)).alias("heavy"))
    heavy = least.where("heavy").select("u", F.col("m").alias("heavy_m"))  # under HEAVY rows, as their ties add up to all
    light = least.where("NOT heavy").select(F.col("u").alias("key"), F.lit(False).alias("of_heavy"), "m")
    known = ties.join(F.broadcast(heavy), "u", "left").withColumn("of_heavy", F.col("heavy_m").isNotNull())
    known = known.withColumn("key", F.when(F.col("of_heavy"), F.col("v")).otherwise(F.col("u")))
    joined = known.join(light, ["key", "of_heavy"], "left").select("u", "v", F.coalesce("heavy_m", "m").alias("m"))
    out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node that the links (a, b) name: label is the least node that it can reach.

    Links that repeat, point both ways or join a node with itself change nothing; those with a null count for nothing.
    Nodes are strings or whole numbers. Up to PART links are one part, and its ties the result; more are contracted in
    parts of about that size, and rounds follow, whose number grows with the logarithm of the longest chain of ties. Each
    is a table in the shared folder, and all but the last are deleted as soon as the next is there. A node may have any
    share of the links.
    """
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).where("node IS NOT NULL").distinct()
    pairs = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a <> b").distinct(), "pairs")
    state, rows = None, pairs.count()
    parts = -(-rows // PART)
    if rows:
        kind = pairs.schema["u"].dataType.simpleString()
        tied = materialize(pairs.coalesce(parts).mapInArrow(_contracted(PART), f"u {kind}, v {kind}"), "pairs")
        drop(pairs)
        pairs, rows = tied, tied.count() if parts > 1 else 0
    while rows:
        tied = materialize(_star(pairs, True, rows), "pairs")
        after = materialize(_star(tied, False, rows), "pairs")  # tied has no more rows than pairs
        drop(pairs, tied)
        pairs = after
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state, rows = now, now[0]
    labels = pairs.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
