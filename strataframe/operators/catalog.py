"""Catalog checks: placement of objects in rooms, coverage of entries, selections, required files, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def placement(objects: DataFrame, rooms: DataFrame) -> DataFrame:
    """objects (key, room, x, y, w, h) with place: ok, outside (its room) or unknown room; rooms: (room, room_w, room_h)."""
    joined = objects.join(rooms.select(F.col("room").alias("of"), "room_w", "room_h"), F.col("room") == F.col("of"), "left")
    out = (F.col("x") < 0) | (F.col("y") < 0) | (F.col("x") + F.col("w") > F.col("room_w")) | (F.col("y") + F.col("h") > F.col("room_h"))
    return joined.select("key", "room", F.when(F.col("of").isNull(), "unknown room").when(out, "outside").otherwise("ok").alias("place"))


def coverage(items: DataFrame, entries: DataFrame) -> DataFrame:
    """(key, problem): keys of items without entry (missing) and of entries without item (extra)."""
    a, b = items.select("key").distinct(), entries.select("key").distinct()
    return a.join(b, "key", "left_anti").withColumn("problem", F.lit("missing")).unionByName(b.join(a, "key", "left_anti").withColumn("problem", F.lit("extra")))


def listed(objects: DataFrame, entries: DataFrame) -> DataFrame:
    """Objects (key, room) that their room's entry (room, skip array) lists."""
    names = entries.select("room", F.explode("skip").alias("key")).distinct()
    return objects.join(names, ["room", "key"], "left_semi")


def selected(rows: DataFrame, key: str, wanted: list) -> DataFrame:
    """Rows of the wanted keys, all rows if there are none; an unknown key is an error."""
    if not wanted:
        return rows
    asked = rows.sparkSession.createDataFrame([(w,) for w in sorted(set(wanted))], rows.select(key).schema)
    unknown = [r[0] for r in asked.join(rows.select(key).distinct(), key, "left_anti").orderBy(key).collect()]
    if unknown:
        raise ValueError(f"unknown {key}: {', '.join(map(str, unknown))}")
    return rows.join(F.broadcast(asked), key, "left_semi")


def absent(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Required keys that are not present."""
    return required.select(key).distinct().join(present.select(key), key, "left_anti")


def version_parts(version: Column) -> Column:
    """The numbers of a dotted version; empty unless all parts are numbers, so older than any."""
    parts = F.split(version, r"\.")
    return F.when(F.forall(parts, lambda p: p.rlike("^[0-9]+$")), F.transform(parts, lambda p: p.cast("int"))).otherwise(F.array().cast("array<int>"))


def at_least(version: Column, least: tuple[int, ...]) -> Column:
    """Whether a version is least or later, compared part by part."""
    return F.coalesce(version_parts(version) >= F.array(*[F.lit(n) for n in least]), F.lit(False))


def first_difference(a: DataFrame, b: DataFrame, ordinal: str, fields: list[str]) -> DataFrame:
    """(ordinal, difference) of two streams zipped by position: short, long or the first field that differs; equal rows go."""
    left = a.select(ordinal, *[F.col(f).alias(f"a_{f}") for f in fields], F.lit(True).alias("in_a"))
    right = b.select(ordinal, *[F.col(f).alias(f"b_{f}") for f in fields], F.lit(True).alias("in_b"))
    out = F.lit(None).cast("string")
    for f in reversed(fields):
        out = F.when(~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), F.lit(f)).otherwise(out)
    out = F.when(F.col("in_a").isNull(), "long").when(F.col("in_b").isNull(), "short").otherwise(out)
    return left.join(right, ordinal, "full_outer").select(ordinal, out.alias("difference")).where("difference IS NOT NULL")
