"""Mixing sources to target weights with a low-discrepancy source schedule.

Each source's documents, shuffled by a keyed hash, form a stream of words that repeats; the stream is cut into blocks
of equal size. The schedule maps golden-ratio points through the cumulative weights of the sources: slot t of n takes
the point t * g mod n, where g is the whole number next to n / golden ratio that shares no factor with n. As these
points are a permutation of the n cells, every source gets exactly its number of slots, evenly spread. A source's
r-th slot takes its r-th block. Texts are dropped as soon as their words are counted: only numbers are shuffled, and
rows that repeat are one row with a count until they are placed.
"""

from __future__ import annotations

from math import gcd, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.llm.common import WORD_CLASS, materialize

#: The weights that sources take in turn, by code point.
WEIGHTS = (5, 2, 1)
COPIES, HEAVY = 1_000, 256  # repeated rows placed at once; texts with more than this part of all copies are dealt out
WORDS_A_TASK = 10_000_000  # of the written mix


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-space characters; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = 3) -> DataFrame:
    """(source, source_size, place, weight, target, quota) from rows (source, size), one row a source.

    Sources ordered by code point, null last, take the weights in turn and share the sum of all sizes by weight;
    no target exceeds most_times its source's size, and the excess goes to the others by weight until none does. So
    targets are min(most_times * size, level * weight), with the level found by sorting sources by the level at which
    they are full. quota: the target in whole words. Only one row a source is ever ordered as a whole.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = by_source.withColumn("place", F.row_number().over(in_order) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
    filled_at = most_times * F.col("source_size") / F.col("weight")
    full = Window.orderBy(filled_at, "place")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    onward = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - most_times * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(onward)
    # the level that fits: that of the first source, in this order, which it does not overfill
    leveled = ranked.withColumn("at", F.struct(filled_at.alias("filled_at"), "place")).withColumn("own_level", level)
    leveled = leveled.withColumn("level", F.min_by("own_level", F.when(F.col("own_level") <= F.col("at.filled_at"), F.col("at"))).over(every))
    cap = (most_times * F.col("source_size")).cast("double")
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least(cap, F.coalesce(F.col("level") * F.col("weight"), cap)))
    return leveled.withColumn("target", target).select("source", "source_size", "place", "weight", "target", F.least(most_times * F.col("source_size"), F.floor(F.col("target") + 0.5)).alias("quota"))


def step_for(slots: int) -> int:
    """The whole number nearest to slots / golden ratio that shares no factor with slots."""
    near = round(slots * (sqrt(5) - 1) / 2)
    return next(g for d in range(slots + 1) for g in (near + d, near - d) if 0 < g <= max(1, slots) and gcd(g, slots) == 1)


def schedule(targets: DataFrame, block_words: int, chunk: int = 100_000) -> DataFrame:
    """(slot, source_place, rank): which source each slot of the mix draws from, and which of its slots it is, from 0.

    Slots are ranked within chunks of the schedule and the chunks' counts are summed up, so that a source with a
    third of all slots is never ranked in one task.
    """
    spark = targets.sparkSession
    quotas = targets.select("place", F.ceil(F.col("quota") / block_words).alias("slots")).where("slots > 0")
    cells = quotas.withColumn("upto", F.sum("slots").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))
    cells = cells.select("place", (F.col("upto") - F.col("slots")).alias("from_cell"), "upto")
    n = targets.select(F.sum(F.ceil(F.col("quota") / block_words))).first()[0] or 0
    if not n:
        return spark.createDataFrame([], "slot long, source_place int, rank long")
    t = F.col("id").cast("decimal(20,0)") if n >= 2**31 else F.col("id")
    drawn = spark.range(0, n, 1, min(10_000, 1 + n // 200_000)).select(F.col("id").alias("slot"), F.pmod(t * step_for(n), F.lit(n)).cast("long").alias("cell"))
    # cells of a source are contiguous: split them into pieces of equal width, so that the lookup is an equi-join
    width = max(1, n // 10_000)
    pieces = cells.select("place", "from_cell", "upto", F.explode(F.sequence(F.floor(F.col("from_cell") / width), F.floor((F.col("upto") - 1) / width))).alias("piece"))
    placed = drawn.withColumn("piece", F.floor(F.col("cell") / width)).join(pieces, "piece").where("cell >= from_cell AND cell < upto").select("slot", F.col("place").alias("source_place"), F.floor(F.col("slot") / chunk).alias("chunk"))
    placed = placed.repartition("source_place", "chunk")
    counts = placed.groupBy("source_place", "chunk").agg(F.count("*").alias("n"))
    ahead = counts.select("source_place", "chunk", (F.sum("n").over(Window.partitionBy("source_place").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("ahead"))
    ranked = placed.withColumn("own", F.row_number().over(Window.partitionBy("source_place", "chunk").orderBy("slot")) - 1)
    return ranked.join(ahead, ["source_place", "chunk"]).select("slot", "source_place", (F.col("ahead") + F.col("own")).alias("rank"))


def block_size(targets: DataFrame, most: int = 256, least_share: int = 64) -> int:
    """Words a block: most, or less so that the average source gets least_share blocks at least."""
    total, sources = targets.agg(F.sum("quota"), F.count_if(F.col("quota") > 0)).first()
    return max(1, min(most, (total or 0) // max(1, least_share * (sources or 0))))


def placed_documents(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: int, weights: tuple[int, ...] = WEIGHTS, most_times: int = 3, carry: tuple[str, ...] = ()):
    """(documents with their place in their source's stream, targets); carry: further columns that go along.

    The stream's order is that of md5 of seed and id, then id and size; repeated rows follow each other. Offsets are
    summed within buckets of the hash, then over the buckets of a source.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary"))
    counted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), key.alias("key"), *carry)
    counted = materialize(counted.groupBy("doc_id", "source", "size", "key", *carry).agg(F.count("*").alias("copies")), "mix-sizes")
    counted = counted.withColumn("bucket", F.conv(F.substring("key", 1, 3), 16, 10).cast("int"))
    targets = materialize(source_targets(counted.select("source", (F.col("size") * F.col("copies")).alias("size")), weights, most_times), "mix-targets")
    t = targets.select(F.col("source").alias("of"), "source_size", "place", "target", "quota")
    rows = counted.join(t, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("words", F.col("size") * F.col("copies"))
    in_bucket = Window.partitionBy("place", "bucket").orderBy("key", F.col("doc_id").asc_nulls_last(), "size", *carry)
    before = lambda c: F.sum(c).over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)) - F.col(c)
    inside = rows.withColumns({"row": before("copies"), "within": before("words")})
    sums = rows.groupBy("place", "bucket").agg(F.sum("words").alias("n"))
    starts = sums.select("place", "bucket", (F.sum("n").over(Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("start"))
    placed = inside.join(starts, ["place", "bucket"]).withColumn("offset", F.col("start") + F.col("within"))
    placed = _each_copy(placed, counted.agg(F.max("copies")).first()[0] or 1)
    return placed.select("doc_id", "source", "size", "bucket", "row", "source_size", "place", "target", "quota", "offset", *carry), targets


def _each_copy(placed: DataFrame, most: int) -> DataFrame:
    """placed with a row, and an offset, for each of its copies; many copies of one row are dealt to tasks in parts."""
    if most < 2:
        return placed
    parts = placed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))))
    if most > COPIES:
        parts = parts.repartition("place", "bucket", "row", "part")
    first = F.col("part") * COPIES
    each = parts.withColumn("i", F.explode(F.sequence(first, F.least(F.col("copies"), first + COPIES) - 1)))
    return each.withColumns({"row": F.col("row") + F.col("i"), "offset": F.col("offset") + F.col("i") * F.col("size")})


def pieces(placed: DataFrame, block_words: int) -> DataFrame:
    """Each document's share of each block of its source's repeated stream, up to the source's quota.

    (all columns of placed, epoch, block, words); a document of which nothing is taken has one row with null block.
    """
    passes = F.when((F.col("size") > 0) & (F.col("quota") > F.col("offset")), F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - F.col("offset") - 1) / F.col("source_size"))))
    start = F.col("offset") + F.col("epoch") * F.col("source_size")
    stop = F.least(start + F.col("size"), F.col("quota"))
    rows = placed.withColumn("epoch", F.explode_outer(passes)).withColumn("start", start).withColumn("stop", stop)
    blocks = F.when(F.col("epoch").isNotNull(), F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("stop") - 1) / block_words)))
    rows = rows.withColumn("block", F.explode_outer(blocks))
    words = F.least(F.col("stop"), (F.col("block") + 1) * block_words) - F.greatest(F.col("start"), F.col("block") * block_words)
    return rows.withColumn("words", words).drop("start", "stop")


def _scheduled(placed: DataFrame, targets: DataFrame, how: str = "inner") -> DataFrame:
    """Each document's shares of blocks with the slots that take them."""
    block_words = block_size(targets)
    return pieces(placed, block_words).join(schedule(targets, block_words), (F.col("place") == F.col("source_place")) & (F.col("block") == F.col("rank")), how)


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 0, weights: tuple[int, ...] = WEIGHTS, most_times: int = 3) -> DataFrame:
    """The mix in order: (slot, doc_id, source, epoch, block, words), one row for each document in each scheduled block.

    A slot's rows make its block; slots in order make the mix.
    """
    return _scheduled(*placed_documents(docs, id_col, source_col, text_col, seed, weights, most_times)).select("slot", "doc_id", "source", "epoch", "block", "words")


def mix_digest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 0, weights: tuple[int, ...] = WEIGHTS, most_times: int = 3) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_slot, last_slot, n_slots), one row a document.

    taken: the words that the mix takes of it, at most most_times the size; a source's sum is its target, rounded.
    first_slot, last_slot and n_slots: when the schedule takes them, null and 0 if never. Null and blank texts have
    size 0 and nothing is taken of them; a null source is a source; null ids, repeated ids and repeated rows each keep
    their row. A source without words has target 0. An empty table gives no row. Other columns are not read.
    """
    taken = _scheduled(*placed_documents(docs, id_col, source_col, text_col, seed, weights, most_times), "left")
    words = F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("words"))), F.lit(0)).cast("long")
    found = taken.groupBy("place", "bucket", "row", "doc_id", "size", "source_size", "target").agg(words.alias("taken"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"), F.count("slot").alias("n_slots"))
    return found.drop("place", "bucket", "row")


def first_words(text: Column, n: Column) -> Column:
    """The first n words of a text with the space before each."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD_CLASS), F.lit(0)), F.lit(1), n), "")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", chars_col: str = "n_chars", seed: int = 0, weights: tuple[int, ...] = WEIGHTS, most_times: int = 3) -> DataFrame:
    """What the mix holds, as rows of docs in the order of the schedule: each document as often as it is taken, cut where
    it is taken in part.

    A copy stands where the first of its blocks is scheduled. Documents of which nothing is taken are missing; a cut
    text has its own number of characters in chars_col. Rows whose id, source and text are equal have the least of
    their other columns. Null and blank texts are never taken; an empty table gives no row.
    """
    marks = [x for c in (text_col, source_col) for x in (F.col(c), F.col(c).isNull())]
    keys = {"__key": F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))), "__hash": F.xxhash64(*marks)}
    placed, targets = placed_documents(docs.withColumns(keys), id_col, source_col, text_col, seed, weights, most_times, ("__key", "__hash"))
    at = (F.col("offset") + F.col("epoch") * F.col("source_size")).alias("__at")
    copies = _scheduled(placed, targets).groupBy("place", "bucket", "row", "__key", "__hash", "size", at).agg(F.min("slot").alias("__slot"), F.sum("words").alias("__taken"))
    copies = materialize(copies.select("__key", "__hash", "__at", "__slot", "__taken", (F.col("__taken") == F.col("size")).alias("__whole")), "mix-copies")
    slots, words, rows = copies.agg(F.max("__slot"), F.sum("__taken"), F.count("*")).first()
    # the copies of a text that makes much of the mix are dealt out, and the text goes to each part of them
    heavy = F.broadcast(copies.groupBy("__key", "__hash").agg(F.count("*").alias("n")).where(F.col("n") * HEAVY > max(rows, HEAVY * COPIES)).drop("n").withColumn("__heavy", F.lit(True)))
    copies = copies.join(heavy, ["__key", "__hash"], "left").withColumn("__part", F.when(F.col("__heavy"), F.pmod(F.xxhash64("__at"), F.lit(HEAVY))).otherwise(F.lit(0).cast("long"))).drop("__heavy")
    others = [c for c in docs.columns if c not in (id_col, text_col, source_col)]
    rest = [F.min(F.struct(*others)).alias("__others")] if others else []
    texts = docs.withColumns(keys).groupBy("__key", "__hash").agg(*[F.first(c).alias(c) for c in (id_col, text_col, source_col)], *rest)
    parts = F.when(F.col("__heavy"), F.sequence(F.lit(0).cast("long"), F.lit(HEAVY - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    texts = texts.join(heavy, ["__key", "__hash"], "left").withColumn("__part", F.explode(parts)).drop("__heavy")
    cut = F.when(F.col("__whole"), F.col(text_col)).otherwise(first_words(F.col(text_col), F.col("__taken").cast("int")))
    mixed = copies.join(texts, ["__key", "__hash", "__part"]).withColumn(text_col, cut)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (words or 0) // WORDS_A_TASK)
    task = F.floor(F.col("__slot").cast("double") * tasks / ((slots or 0) + 1)).cast("int")
    mixed = mixed.withColumn("__task", task).repartitionById(tasks, "__task").sortWithinPartitions("__slot", "__at")
    chars = lambda c: F.when(F.col("__whole"), F.col(f"__others.`{c}`")).otherwise(F.length(text_col)).alias(c) if c == chars_col else F.col(f"__others.`{c}`").alias(c)
    return mixed.select(*[chars(c) if c in others else c for c in docs.columns])
