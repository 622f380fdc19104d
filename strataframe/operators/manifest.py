"""Manifest tables: asset ids, counts, hashes, errors, censuses and invariants over asset and chunk rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.session import materialized


def asset_id(family: Column, source: Column, frame: Column, name: Column) -> Column:
    """family:source:00007 for a frame, family:name for others."""
    return F.when(frame.isNull(), F.concat_ws(":", family, name)).otherwise(F.concat_ws(":", family, F.lower(source), F.format_string("%05d", frame)))


def asset_json(*columns: str, always: tuple[str, ...] = ("frame", "name")) -> Column:
    """The row as JSON: null fields are left out, but for those that are always written."""
    missing = F.struct(*[F.when(F.col(c).isNull(), F.lit(f'"{c}":null')).alias(c) for c in always])
    nulls = F.concat_ws(",", *[missing[c] for c in always])
    plain = F.to_json(F.struct(*columns))
    return F.when(nulls == "", plain).otherwise(F.concat(F.regexp_replace(plain, r"\}$", ""), F.when(plain != "{}", ",").otherwise(""), nulls, F.lit("}")))


def family_totals(assets: DataFrame) -> DataFrame:
    """(family, n, total): assets (id, size) counted and summed by what stands before the first colon of the id."""
    return assets.groupBy(F.substring_index("id", ":", 1).alias("family")).agg(F.count("*").alias("n"), F.sum("size").alias("total"))


def palettes(assets: DataFrame, palette: str) -> DataFrame:
    """(hash, uses): content-addressed palettes, one row each however often they are used."""
    return assets.groupBy(F.sha2(F.col(palette).cast("binary"), 256).alias("hash")).agg(F.count("*").alias("uses"))


def bundle_hash(files: DataFrame, bundle: str, separator: str = "\x00") -> DataFrame:
    """(bundle, hash) over the sorted (path, size) of each bundle's files.

    A bundle's lines are hashed one after the other as they come from the sort, so no listing is ever held as a whole.
    """
    lines = files.select(F.col(bundle).alias("bundle"), "path", F.col("size").cast("string").alias("size"), F.col("size").alias("by_size"))
    lines = lines.repartition("bundle").sortWithinPartitions("bundle", "path", "by_size").drop("by_size")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest = None, None
        for frame in frames:
            done = []
            for of, path, size in zip(frame["bundle"].array, frame["path"], frame["size"], strict=True):
                of = None if pd.isna(of) else of
                if digest is None or of != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = of, hashlib.sha256()
                digest.update(f"{path}{separator}{size}{separator}".encode())
            yield pd.DataFrame(done, columns=["bundle", "hash"])
        if digest is not None:
            yield pd.DataFrame([(now, digest.hexdigest())], columns=["bundle", "hash"])

    kind = lines.schema["bundle"].dataType.simpleString()
    return lines.mapInPandas(run, f"bundle {kind}, hash string").withColumnRenamed("bundle", bundle)


def numbered(rows: DataFrame, group: str, order: list[str], name: str = "place") -> DataFrame:
    """rows with their place in their group, from 0, by order; a group may have any share of the rows.

    Rows are dealt to ranges of group and order and written once; places count on from the ranges before, of which only
    the counts are added up.
    """
    written = materialized(rows.repartitionByRange(group, *order).withColumn("__range", F.spark_partition_id()), "numbered")
    counts = written.groupBy("__range", group).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    starts = counts.select(F.col("__range").alias("of_range"), F.col(group).alias("of_group"), before.alias("start"))
    own = F.row_number().over(Window.partitionBy("__range", group).orderBy(*order)) - 1
    met = (F.col("__range") == F.col("of_range")) & F.col(group).eqNullSafe(F.col("of_group"))
    return written.withColumn("__own", own).join(starts, met).select(*rows.columns, (F.col("start") + F.col("__own")).alias(name))


def shown_errors(errors: DataFrame, shown: int = 5) -> DataFrame:
    """(source, rank, offset, reason, more): the first errors of each source, and how many more it has."""
    w = Window.partitionBy("source").orderBy("offset", "ord")
    ranked = errors.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= shown)  # a top-k a source: Spark limits each partition first
    counts = errors.groupBy("source").agg(F.count("*").alias("n"))
    return ranked.join(counts, "source").select("source", "rank", "offset", "reason", F.greatest(F.col("n") - shown, F.lit(0)).alias("more"))


def union_records(*tables: DataFrame) -> DataFrame:
    """All rows of record tables, by column name; columns that a table lacks are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def census(chunks: DataFrame, tag: str, size: str) -> DataFrame:
    """(tag, n, total, least, most) of chunk sizes."""
    return chunks.groupBy(F.col(tag).alias("tag")).agg(F.count("*").alias("n"), F.sum(size).alias("total"), F.min(size).alias("least"), F.max(size).alias("most"))


def histogram(rows: DataFrame, code: str, names: DataFrame) -> DataFrame:
    """(code, label, n): rows by code, named by the small table names (code, name); '?' for others."""
    counted = rows.groupBy(F.col(code).alias("code")).agg(F.count("*").alias("n"))
    return counted.join(F.broadcast(names), "code", "left").select("code", F.concat(F.col("code").cast("string"), F.lit(" "), F.coalesce("name", F.lit("?"))).alias("label"), "n")


def contiguous(blocks: DataFrame, group: str) -> DataFrame:
    """(group, contiguous, strips_fit): whether each block starts where the one before ends and widths are whole strips."""
    after = F.lead("start").over(Window.partitionBy(group).orderBy("start", "size"))
    return blocks.withColumn("after", after).groupBy(group).agg(F.bool_and(F.coalesce(F.col("after") == F.col("start") + F.col("size"), F.lit(True))).alias("contiguous"), F.bool_and(F.col("width") % 8 == 0).alias("strips_fit"))


def batches(rows: DataFrame, group: str, key: str, size: int = 8) -> DataFrame:
    """(group, batch, keys): each group's keys in order, dealt to batches of size, a batch's keys joined by commas."""
    dealt = numbered(rows.select(group, key), group, [key]).select(group, key, F.floor(F.col("place") / size).cast("int").alias("batch"))
    return dealt.groupBy(group, "batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda k: k.cast("string")), ",").alias("keys"))


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def classified(chunks: DataFrame, classes: DataFrame) -> DataFrame:
    """chunks with class and note, by the small table classes (tag, class, note); unknown tags are unclassified."""
    joined = chunks.join(F.broadcast(classes), "tag", "left")
    return joined.withColumns({"class": F.coalesce("class", F.lit("unknown")), "note": F.coalesce("note", F.lit("unclassified"))})


def histogram_text(rows: DataFrame, group: str, code: str) -> DataFrame:
    """(group, line): each group's counts as {code: n, ...}, codes in order."""
    counts = rows.groupBy(group, code).agg(F.count("*").alias("n"))
    entries = F.transform(F.array_sort(F.collect_list(F.struct(F.col(code).alias("c"), "n"))), lambda e: F.concat(e["c"].cast("string"), F.lit(": "), e["n"].cast("string")))
    return counts.groupBy(group).agg(F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}")).alias("line"))
