"""Bottom-k document fingerprints: the k smallest distinct shingle hashes, as sorted array<long> columns.

Sketches of parts merge into the sketch of the whole (bottom-k of the union), and estimate resemblance, containment
and the number of distinct shingles. Everything is a JVM expression over one row, so fingerprinting never shuffles.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.llm.common import range_of

K = 128
SHINGLE = 5
BITS = 48  # of a shingle's hash that a sketch keeps; 12 hexadecimal digits
LOWEST = -(2**63)


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the lower-cased words, in order; empty for null and blank texts."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.transform(F.filter(split, lambda w: w != ""), lambda w: F.xxhash64(w))


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch_of(words: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """Sketch of an array of word hashes; with fewer words than a shingle, of the whole sequence as one shingle.

    words must be a column of the input, not an expression: the shingles look it up again and again.
    """
    n = F.size(words)
    at = F.when(n >= shingle, F.sequence(F.lit(0), n - shingle)).otherwise(F.array().cast("array<int>"))
    cut = lambda h: F.shiftrightunsigned(h, 64 - BITS)
    many = F.transform(at, lambda i: cut(F.xxhash64(*[F.get(words, i + j) for j in range(shingle)])))
    one = F.when(n > 0, F.array(cut(F.xxhash64(words)))).otherwise(F.array().cast("array<long>"))
    return F.when(n >= shingle, bottom(many, k)).otherwise(one)


def with_sketch(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """Adds the sketch of a text column as name."""
    hashes = f"{name}__words"
    return df.withColumn(hashes, word_hashes(F.col(text))).withColumn(name, sketch_of(F.col(hashes), k)).drop(hashes)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact for sketches that hold fewer than k hashes."""
    kth = F.element_at(a, k) / F.lit(float(2**BITS))
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / kth)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, 0 to 1; two empty sketches: 1. Exact if both hold fewer than k hashes."""
    whole = F.array_union(a, b)
    union = F.when((F.size(a) < k) & (F.size(b) < k), whole).otherwise(F.slice(F.sort_array(whole), 1, k))
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1; an empty a is contained in everything."""
    j, na, nb = resemblance(a, b, k), distinct_count(a, k), distinct_count(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j * (na + nb) / (1 + j) / na))


def as_text(a: Column) -> Column:
    """Sketch as a string: 12 lower-case hexadecimal digits a hash, in order; '' for an empty one."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), BITS // 4, "0")), "")


def merge_by(df: DataFrame, by: list[str], name: str, k: int = K, fan_in: int = 64) -> DataFrame:
    """One row a group with the merged sketch of all its rows, in rounds of at most about fan_in sketches a task's group.

    A group of any size, even a third of the rows, never meets in one aggregation: rows get a random-like salt from
    their own sketch and group, equal sketches being merged first, and the salts are narrowed until one is left.
    Null group values form a group; null sketches count as empty.
    """
    cols = [F.col(c) for c in by]
    empty = F.array().cast("array<long>")
    rows = df.select(*cols, F.coalesce(F.col(name), empty).alias(name)).distinct()
    largest = rows.groupBy(*cols).count().agg(F.max("count")).first()[0] or 0
    while largest > 1:
        salts = max(1, -(-largest // fan_in))
        gathered = rows.groupBy(*cols, F.pmod(F.xxhash64(name), F.lit(salts)).alias("__salt")).agg(F.collect_list(name).alias(name))
        rows = gathered.select(*cols, bottom(F.flatten(name), k).alias(name))
        largest = salts if salts > 1 else 1
    return rows


def in_ranges(docs: DataFrame, id_col: str, rows_per_range: int = 2000) -> DataFrame:
    """docs dealt to ranges of ids by one exchange, with the columns __key, __at (the range) and __guard.

    Ranges end at sampled ids (those whose hash is 0 modulo the wanted number of rows) and at the largest, and are
    found by binary search. They have about rows_per_range rows, or the square root of the number of rows if that is
    more, so that the ranges and their number grow alike. The first row of each range by descending id is also sent to
    the range above, the first of all to the last range, as a guard that lead() can see: no row needs a second join.
    Null ids count as the smallest.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST))
    ids = docs.select(key.alias("id"))
    n, largest = ids.agg(F.count("*"), F.max("id")).first()
    modulus = max(rows_per_range, isqrt(n))
    cuts = sorted({largest or 0} | {r.id for r in ids.where(F.pmod(F.xxhash64("id"), F.lit(modulus)) == 0).distinct().collect()})
    edges = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<long>")
    place = lambda at, guard: F.struct(at.alias("at"), F.lit(guard).alias("guard"))
    own = F.col("__own")
    places = F.when(F.get(edges, own) == F.col("__key"), F.array(place(own, False), place(F.pmod(own + 1, F.lit(len(cuts))), True))).otherwise(F.array(place(own, False)))
    rows = docs.withColumn("__key", key).withColumn("__own", range_of(F.col("__key"), cuts)).withColumn("__place", F.explode(places))
    return rows.withColumns({"__at": F.col("__place.at"), "__guard": F.col("__place.guard")}).drop("__own", "__place").repartition("__at")


def with_next(ranges: DataFrame, carried: list[str], tie: str) -> DataFrame:
    """The rows of in_ranges() with next_<c> for each carried column: that of the next row by descending id.

    Rows of one id are ordered by the column tie.
    """
    w = Window.partitionBy("__at").orderBy("__guard", F.col("__key").desc(), tie)
    return ranges.withColumns({f"next_{c}": F.lead(c).over(w) for c in carried}).where("NOT __guard").drop("__key", "__at", "__guard")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Fingerprints of whole texts and of their edited texts, with the likeness of neighbours; one row a document.

    Edited text: the last floor(n / 2) of the n code points give way to the first as many (or all, if there are fewer)
    of the next document by descending id; after the last comes the first, so a lone document follows itself. Null
    texts count as empty, null ids as the smallest; rows of one id are ordered by text, and repeated rows each give a
    row. Two empty texts have likeness 1, an empty and a filled one 0. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(with_sketch(in_ranges(rows, "doc_id"), "text", "sketch", k), ["text", "sketch"], "text")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half)))
    rows = with_sketch(rows.withColumn("n_chars", n.cast("long")).drop("text", "next_text"), "edited", "edited_sketch", k)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch"), k).alias("contained_edited"),
        distinct_count(F.col("sketch"), k).alias("n_shingles_estimated"),
    )
