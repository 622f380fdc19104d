"""Extraction: a tree of container files to PNG files, palettes, a manifest and an error document."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators import manifest
from strataframe.plans import services
from strataframe.sources import container, frames, sinks, tables

#: Kinds of files in their order, what their names look like, and the manifest's counters.
KINDS = {"san": "*.SAN", "nut": "*.NUT", "la1": "*.LA1", "akos": "*.LA1"}
COUNTERS = {"san": "san_frames", "nut": "nut_images", "la1": "la1_bitmaps", "akos": "la1_bitmaps"}
ASSET_KIND = {"san": "san_frame", "nut": "nut_image", "la1": "la1_bitmap", "akos": "la1_bitmap"}
TOOL, VERSION = "strataframe", "0.2.0"
SHOWN = 1_000  # errors that a result holds; the error document has all


@dataclass
class Result:
    """status: 0, 1 with errors, 2 if nothing could be done; errors: the first ones."""

    status: int
    counts: dict[str, int]
    errors: list[dict]
    palettes: int


def wanted_kinds(text: str | None) -> list[str]:
    """Kinds named by commas, in their own order; all without any, and an unknown one is an error."""
    if not text:
        return list(KINDS)
    named = {part.strip().lower() for part in text.split(",")}
    if unknown := named - KINDS.keys():
        raise ValueError(f"unknown kind(s) {', '.join(sorted(unknown))}; choose from {', '.join(KINDS)}")
    return [k for k in KINDS if k in named]


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, size) of all files below root, relative to it; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size"))
    return files.withColumn("path", relative(F.col("path"), root))


def relative(path: Column, root: str) -> Column:
    plain = root.removeprefix("file://").rstrip("/") + "/"
    return F.substring_index(path, plain, -1)


def bitmaps(spark: SparkSession, root: str, kinds: list[str]) -> DataFrame:
    """All bitmap and error rows with family, frame and the path of their picture; every file is scanned once."""
    parts = []
    stem = F.regexp_extract("source", r"([^/]+)\.[^./]*$", 1)
    columns = ["source", "frame", "name", "width", "height", "transparent", "index", "palette", "room", "x", "y", "path", "offset", "error"]
    if "san" in kinds:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", KINDS["san"]).load(root)
        none = {c: F.lit(None).cast(t) for c, t in (("name", "string"), ("transparent", "int"), ("room", "int"), ("x", "int"), ("y", "int"))}
        rows = frames.scan_frames(files).withColumns(none | {"width": F.lit(frames.WIDTH), "height": F.lit(frames.HEIGHT)})
        parts.append(rows.withColumns({"family": F.lit("san"), "path": F.concat(F.lit("san/"), stem, F.format_string("/%05d.png", "frame"))}))
    if "nut" in kinds:
        rows = container.scan(spark, root, "font", KINDS["nut"]).withColumn("frame", F.col("cel"))
        parts.append(rows.withColumns({"family": F.lit("nut"), "path": F.concat(F.lit("nut/"), stem, F.format_string("/img_%03d.png", "frame"))}))
    if archives := [k for k in ("la1", "akos") if k in kinds]:
        kind = F.when(F.col("family") == "image", "la1").when(F.col("family") == "cel", "akos").otherwise(archives[0])
        rows = container.scan_rooms(spark, root, KINDS["la1"]).withColumns({"family": kind, "frame": F.lit(None).cast("int"), "path": F.concat(F.lit("la1/"), "name", F.lit(".png"))})
        parts.append(rows.where(F.col("family").isin(archives)))
    return manifest.union_records(*[p.withColumn("source", relative(F.col("source"), root)).select("family", *columns) for p in parts])


def extract(spark: SparkSession, root: str, out_dir: str, extracted_at: str, only: str | None = None) -> Result:
    """Extracts all files of the wanted kinds; status 0, or 1 if there were errors.

    The manifest lists the assets by source, frame and id, and comes last; it is written as it is read, an asset at a
    time. Errors cost their image, or for fonts and animations the rest of their file.
    """
    kinds = wanted_kinds(only)
    rows = bitmaps(spark, root, kinds).persist()
    try:
        good = rows.where("error IS NULL")
        written = sinks.write_pictures(good, out_dir).persist()
        palettes = sinks.write_palettes(written, out_dir)
        stem = F.regexp_extract("source", r"([^/]+)\.[^./]*$", 1)
        assets = written.select(
            manifest.asset_id(F.col("family"), stem, F.col("frame"), F.col("name")).alias("id"), F.element_at(F.create_map(*[F.lit(x) for kv in ASSET_KIND.items() for x in kv]), F.col("family")).alias("kind"),
            "source", "frame", "name", "width", "height", "has_alpha", F.sha2("palette", 256).alias("palette"), "path", "room", "x", "y",
        )
        bad = rows.where("error IS NOT NULL").select("source", "offset", F.col("error").alias("reason")).orderBy("source", "offset")
        counts = dict.fromkeys([*COUNTERS.values(), "errors"], 0)
        for r in written.groupBy("family").agg(F.count("*").alias("n")).collect():
            counts[COUNTERS[r.family]] += r.n
        counts["errors"] = bad.count()
        root_hash = manifest.bundle_hash(listing(spark, root).withColumn("bundle", F.lit(0)), "bundle").first()
        sinks.write_errors((r.asDict() for r in bad.toLocalIterator()) if counts["errors"] else [], f"{out_dir}/_errors.json")
        listed = (r.asDict() for r in assets.orderBy("source", F.coalesce("frame", F.lit(-1)), "id").toLocalIterator())
        sinks.write_parts(f"{out_dir}/manifest.json", tables.asset_document(counts, listed, TOOL, VERSION, extracted_at, root_hash.hash if root_hash else ""))
        errors = [r.asDict() for r in bad.limit(SHOWN).collect()]
        written.unpersist()
    finally:
        rows.unpersist()
    return Result(1 if counts["errors"] else 0, counts, errors, palettes)


def extract_checked(spark: SparkSession, root: str, out_dir: str, extracted_at: str, only: str | None = None, required: list[str] = [], least_free: int = 0) -> Result:  # noqa: B006
    """extract(), but a wrong kind, a missing required file or too little space is status 2, and nothing is read then.

    least_free counts where out_dir is a local folder.
    """
    said = []
    try:
        wanted_kinds(only)
    except ValueError as e:
        said.append(str(e))
    said += [f"missing {name}" for name in missing_files(spark, root, required)]
    if least_free and out_dir.startswith("file:") and services.disk_free(out_dir.removeprefix("file://")) < least_free:
        said.append(f"fewer than {least_free} bytes are free")
    if said:
        return Result(2, {}, [{"source": root, "offset": None, "reason": s} for s in said], 0)
    return extract(spark, root, out_dir, extracted_at, only)


def game_root(folder: str, below: str) -> str:
    """Where the files lie in a folder that a user names."""
    return f"{folder.rstrip('/')}/{below.strip('/')}"


def missing_files(spark: SparkSession, root: str, required: list[str]) -> list[str]:
    """Required paths that are not below root."""
    fs, path = pafs.FileSystem.from_uri(root)
    return [r for r in required if fs.get_file_info(f"{path}/{r}").type == pafs.FileType.NotFound]
