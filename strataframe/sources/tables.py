"""Small tables kept as YAML and JSON documents: room entries, reviews, the asset manifest, the attempt log."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow.fs as pafs
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators.catalog import at_least
from strataframe.sources.sinks import json_list

#: Kinds, styles, review sources, and what keys look like.
KINDS, STYLES, REVIEW_SOURCES = ("scene", "insert", "skip"), ("painted", "rendered"), ("review", "geometry")
ROOM_KEY, OBJECT_KEY = r"room_\d{3}", r"obj\d{3,}_[0-9A-F]{2}"
MIN_VERSION = (0, 2, 0)

ROOMS = "key string, kind string, caption string, style string, skip_objects array<string>"
REVIEWS = "key string, attempt int, accepted boolean, issues array<string>, source string"
ASSET = "id string, kind string, source string, frame int, name string, width int, height int, has_alpha boolean, palette string, path string, room int, x int, y int"
MANIFEST = f"tool string, tool_version string, extracted_at string, game_root string, counts map<string,long>, assets array<struct<{', '.join(c.replace(' ', ':') for c in ASSET.split(', '))}>>"


class TableError(ValueError):
    """A document does not have the shape that it should."""


def _text(x) -> bool:
    return isinstance(x, str)


def _filled(x) -> bool:
    return isinstance(x, str) and bool(x.strip())


def _each(check: Callable) -> Callable:
    return lambda x: isinstance(x, list) and all(map(check, x))


def _among(*values: str) -> Callable:
    return lambda x: x in values


def _like(pattern: str) -> Callable:
    return lambda x: isinstance(x, str) and re.fullmatch(pattern, x) is not None


#: field: (check, what it must be, value if it is missing or empty; ... if it must be there)
ROOM_FIELDS = {
    "kind": (_among(*KINDS), f"one of {', '.join(KINDS)}", ...),
    "caption": (_text, "a string", ""),
    "style": (_among("", *STYLES), f"one of {', '.join(STYLES)}", ""),
    "skip_objects": (_each(_like(OBJECT_KEY)), "a list of object keys (objNNN_SS)", []),
}
REVIEW_FIELDS = {
    "attempt": (lambda x: type(x) is int and x >= 0, "a non-negative integer", ...),
    "accepted": (lambda x: type(x) is bool, "true or false", ...),
    "issues": (_each(_filled), "a list of non-empty strings", ...),
    "source": (_among(*REVIEW_SOURCES), f"one of {', '.join(REVIEW_SOURCES)}", "review"),
}


def read_text(uri: str) -> str | None:
    """The file's text, or None without such a file."""
    fs, path = pafs.FileSystem.from_uri(uri)
    if fs.get_file_info(path).type != pafs.FileType.File:
        return None
    with fs.open_input_stream(path) as f:
        return f.read().decode("utf-8")


def _entries(uri: str, key: str, fields: dict, optional: bool) -> list[dict]:
    """Checked rows of a mapping document; an unknown field, a wrong key or value is an error that names it."""
    text = read_text(uri)
    if text is None:
        if optional:
            return []
        raise TableError(f"{uri}: file not found")
    try:
        found = yaml.safe_load(text) or {}
    except yaml.YAMLError as e:
        raise TableError(f"{uri}: invalid YAML: {e}") from e
    if not isinstance(found, dict):
        raise TableError(f"{uri}: expected a mapping")
    rows = []
    for k, entry in found.items():
        if not _like(key)(k):
            raise TableError(f"{uri}: {k!r} is not a key of this table")
        if not isinstance(entry, dict):
            raise TableError(f"{uri}: {k}: expected a mapping")
        if unknown := sorted(set(entry) - set(fields)):
            raise TableError(f"{uri}: {k}: unknown field(s) {', '.join(unknown)}")
        row = {"key": k}
        for name, (check, must, default) in fields.items():
            value = entry.get(name)
            if default is not ... and not value and value is not False and value != 0:
                value = default
            if not check(value):
                raise TableError(f'{uri}: {k}: "{name}" must be {must}, got {value!r}')
            row[name] = value
        rows.append(row)
    return rows


def load_rooms(spark: SparkSession, uri: str) -> DataFrame:
    return spark.createDataFrame(_entries(uri, ROOM_KEY, ROOM_FIELDS, False), ROOMS)


def load_reviews(spark: SparkSession, uri: str, optional: bool = False) -> DataFrame:
    rows = _entries(uri, f"{ROOM_KEY}|{OBJECT_KEY}", REVIEW_FIELDS, optional)
    for r in rows:
        if r["accepted"] != (not r["issues"]):
            raise TableError(f'{uri}: {r["key"]}: "accepted" contradicts "issues"')
    return spark.createDataFrame(rows, REVIEWS)


class _Dumper(yaml.SafeDumper):
    pass


_Dumper.add_representer(str, lambda d, s: d.represent_scalar("tag:yaml.org,2002:str", s, style=">" if "\n" in s else None))


def _tidy(text: str) -> str:
    return "\n".join(line.rstrip() for line in text.splitlines()).rstrip("\n")


def dump(rows: DataFrame, fields: dict, blank: tuple[str, ...] = ()) -> str:
    """YAML of a small table by key; fields named in blank are left out where they are empty."""
    out = {}
    for r in sorted(rows.collect(), key=lambda r: r.key):
        values = {f: [_tidy(x) for x in r[f]] if isinstance(r[f], list) else _tidy(r[f]) if isinstance(r[f], str) else r[f] for f in fields}
        out[r.key] = {f: v for f, v in values.items() if v or f not in blank}
    return yaml.dump(out, Dumper=_Dumper, sort_keys=False, allow_unicode=True, width=1_000_000)


def load_manifest(spark: SparkSession, uri: str, tool: str) -> DataFrame:
    """Asset rows of a manifest document; another tool's, an old one and one that is no JSON are errors."""
    found = spark.read.schema(MANIFEST + ", _corrupt string").option("multiLine", "true").option("columnNameOfCorruptRecord", "_corrupt").json(uri).cache()
    try:
        head = found.select("tool", "tool_version", "_corrupt", at_least(F.col("tool_version"), MIN_VERSION).alias("fits"), F.col("assets").isNotNull().alias("listed")).first()
    finally:
        found.unpersist()
    if head is None or head["_corrupt"] is not None:
        raise TableError(f"{uri}: invalid JSON")
    if head.tool != tool:
        raise TableError(f"{uri}: not a {tool} manifest")
    if not head.fits:
        raise TableError(f"{uri}: tool_version {head.tool_version!r} has no object placement")
    if not head.listed:
        raise TableError(f'{uri}: expected an "assets" list')
    return found.select(F.explode("assets").alias("a")).select("a.*")


def rooms_and_objects(assets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rooms by number, objects by key) among a manifest's assets; a name that is neither, a doubled one and a wrong value
    raise when read."""
    own = assets.where("kind = 'la1_bitmap' AND id LIKE 'la1:%'")
    number = F.regexp_extract("name", r"^room(\d{3})$", 1)
    is_room, is_object = F.coalesce(number != "", F.lit(False)), F.coalesce(F.col("name").rlike(f"^{OBJECT_KEY}$"), F.lit(False))
    wrong = (
        F.when(~is_room & ~is_object, F.concat(F.lit("unexpected asset name "), F.coalesce("name", F.lit("null"))))
        .when(F.coalesce(F.col("width") < 1, F.lit(True)) | F.coalesce(F.col("height") < 1, F.lit(True)) | F.coalesce(F.col("room") < 1, F.lit(True)), F.concat("name", F.lit(": width, height and room must be positive integers")))
        .when(F.col("has_alpha").isNull(), F.concat("name", F.lit(': "has_alpha" must be true or false')))
        .when(is_room & (number.try_cast("int") != F.col("room")), F.concat("name", F.lit(": another room's number")))
        .when(is_room & (F.col("width") % 8 != 0), F.concat("name", F.lit(': "width" must be a multiple of 8')))
        .when(is_object & (F.col("x").isNull() | F.col("y").isNull()), F.concat("name", F.lit(': "x" and "y" must be integers')))
        .when(F.coalesce(F.col("path").rlike(r"^/|(^|/)\.\.(/|$)") | (F.col("path") == ""), F.lit(True)), F.concat("name", F.lit(': "path" is no relative path below the folder of pictures')))
    )
    checked = own.withColumn("name", F.when(wrong.isNotNull(), F.raise_error(wrong)).otherwise(F.col("name")))
    rooms = checked.where(is_room).groupBy("room").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("name", "width", "height", "has_alpha", "path")])
    rooms = rooms.withColumn("room", F.when(F.col("n") > 1, F.raise_error(F.format_string("duplicate room %d", "room"))).otherwise(F.col("room"))).drop("n")
    objects = checked.where(is_object).groupBy("name").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("room", "x", "y", "width", "height", "has_alpha", "path")])
    objects = objects.withColumn("name", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("duplicate object "), "name"))).otherwise(F.col("name"))).drop("n")
    return rooms.withColumn("key", F.format_string("room_%03d", "room")).orderBy("room"), objects.withColumnRenamed("name", "key").orderBy("key")


def attempt_log(spark: SparkSession, root: str) -> DataFrame:
    """(key, n, record, promoted, output_sha256, workflow) of the files attempt-N.* below root/<key>/.

    A number counts once anything of it is there; a record that is no JSON object is none.
    """
    every = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    records = every.option("pathGlobFilter", "*.json").load(root).select("path", F.decode("content", "UTF-8").alias("body"))
    files = every.option("pathGlobFilter", "*").load(root).select("path").where("path NOT LIKE '%.json'")  # pictures are listed, not read
    files = records.unionByName(files, allowMissingColumns=True)
    name = F.regexp_extract("path", r"([^/]+)/attempt-(\d+)(?:\.[^/]*)?(?:/[^/]*)?$", 1)
    n = F.regexp_extract("path", r"/attempt-(\d+)(?:\.|/|$)", 1)
    body = F.when(F.col("path").rlike(r"/attempt-\d+\.json$"), F.col("body"))
    parsed = F.from_json(body, "promoted boolean, output_sha256 string, workflow string", {"mode": "PERMISSIVE"})
    good = body.isNotNull() & F.json_object_keys(body).isNotNull()
    rows = files.where(n != "").select(name.alias("key"), n.cast("int").alias("n"), F.when(good, parsed).alias("r"))
    return rows.groupBy("key", "n").agg(F.max(F.col("r").isNotNull()).alias("record"), F.max("r.promoted").alias("promoted"), F.max("r.output_sha256").alias("output_sha256"), F.max("r.workflow").alias("workflow")).withColumn("promoted", F.coalesce("promoted", F.lit(False)))


def asset_document(counts: dict[str, int], assets: Iterable[dict], tool: str, version: str, extracted_at: str, root_hash: str) -> Iterator[bytes]:
    """The manifest document in parts, an asset each; placement is left out where there is none, frame and name are
    written even if null."""
    head = json.dumps({"tool": tool, "tool_version": version, "extracted_at": extracted_at, "game_root": root_hash, "counts": counts}, indent=2)
    yield head.removesuffix("\n}").encode() + b',\n  "assets": '
    yield from json_list(({k: v for k, v in a.items() if v is not None or k not in ("room", "x", "y")} for a in assets), "  ")
    yield b"\n}\n"
