"""Helpers shared by the pipeline operators: the shared scratch folder, table reads, text primitives."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: The white space that separates words, as a Java and Python character class body.
WORD_CLASS = r"[^\x20\x09-\x0D]+"
_SCRATCH: dict[str, str] = {}
_KEPT: list[list[str]] = []
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Sends Python workers at most so many rows at once, from now on in this session: whole texts are long rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); local mode alone can do without."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file:///tmp/checkpoints/strataframe"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_dir(spark: SparkSession, tag: str) -> str:
    """A new folder of the session's scratch space, which goes when the driver's interpreter ends in good order."""
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = f"{shared_dir(spark)}/scratch-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_clean, spark, _SCRATCH[app])
    path = f"{_SCRATCH[app]}/{tag}-{uuid.uuid4().hex}"
    for made in _KEPT:
        made.append(path)
    return path


@contextmanager
def scratch_made() -> Iterator[list[str]]:
    """The list of the folders that new_dir() gives out meanwhile, for whoever knows when they are done with."""
    made: list[str] = []
    _KEPT.append(made)
    try:
        yield made
    finally:
        _KEPT[:] = [m for m in _KEPT if m is not made]


def _clean(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session has ended before
        remove(spark, path)


def materialize(df: DataFrame, tag: str, compression: str = "uncompressed") -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: cuts lineage, survives lost executors.

    Hashes and numbers hardly compress, and the buffers of codecs lie outside the heap; tables of texts name a codec.
    There is no success marker: in a local folder, its two files would start a chmod process of the driver each.
    """
    spark = df.sparkSession
    path = new_dir(spark, tag)
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def remove(spark: SparkSession, *paths: str) -> None:
    """Deletes scratch tables, through the file system of their own path."""
    for path in paths:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def drop(*tables: DataFrame) -> None:
    """Deletes tables that materialize() returned, once nothing reads them any more."""
    for t in tables:
        remove(t.sparkSession, t.scratch_path)


def range_of(key: Column, edges: list[int]) -> Column:
    """Place of the first of the sorted edges that is not below key, by binary search; the last one for greater keys."""
    held = F.split(F.lit(",".join(map(str, edges))), ",").cast("array<long>")
    state = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        return F.when(F.get(held, mid) >= key, state(s["lo"], mid)).otherwise(state(F.least(s["hi"], mid + 1), s["hi"]))

    return F.aggregate(F.sequence(F.lit(1), F.lit(len(edges).bit_length() + 1)), F.struct(F.lit(0).alias("lo"), F.lit(len(edges) - 1).alias("hi")), halve, lambda s: s["lo"])


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Maximal runs of non-space characters, in order; an empty array for null, empty and blank texts."""
    return F.coalesce(F.regexp_extract_all(c, F.lit(f"({WORD_CLASS})"), F.lit(1)), F.array().cast("array<string>"))


def documents_only(df: DataFrame) -> DataFrame:
    return df.select(*DOCUMENT_COLUMNS)
