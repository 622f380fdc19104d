"""Sinks: image files, content-addressed palettes, the manifest and error documents, all through temporary names."""

from __future__ import annotations

import json
import textwrap
import uuid
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.functions import raster
from strataframe.sources import codecs


def write_atomic(uri: str, content: bytes) -> None:
    """The file appears whole or not at all; writing it again replaces it."""
    write_parts(uri, [content])


def write_parts(uri: str, parts: Iterable[bytes]) -> None:
    """write_atomic() for contents that come in parts, which are written as they come."""
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temp) as out:
        for part in parts:
            out.write(part)
    fs.move(temp, path)


def json_list(rows: Iterable[dict], indent: str = "") -> Iterator[bytes]:
    """A JSON list, a row at a time, with two blanks a level."""
    first = True
    for row in rows:
        yield (("[" if first else ",") + "\n" + textwrap.indent(json.dumps(row, indent=2), indent + "  ")).encode()
        first = False
    yield b"[]" if first else f"\n{indent}]".encode()


def delete(uri: str) -> None:
    fs, path = pafs.FileSystem.from_uri(uri)
    if fs.get_file_info(path).type == pafs.FileType.File:
        fs.delete_file(path)


def picture(index: bytes, width: int, height: int, palette: bytes, transparent: int | None) -> tuple[bytes, bytes, bool]:
    """(PNG, palette as written, has alpha): the transparent colour is moved to index 0, whose alpha is 0."""
    if transparent is not None:
        index, palette = codecs.without_transparent_colour(index, palette, transparent)
    shown = raster.coloured(np.frombuffer(index, np.uint8).reshape(height, width), palette, transparent is not None)
    return raster.png_encode(shown), palette, transparent is not None


def write_pictures(bitmaps: DataFrame, out_dir: str) -> DataFrame:
    """Writes the PNG of each row (path, index, width, height, palette, transparent, ...) and returns the rows with the
    palette as written and has_alpha, without index.

    A row is a file of its own name, so a task that runs again writes the same bytes again.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            palettes, alphas = [], []
            for path, index, w, h, palette, hole in zip(*(frame[c] for c in ("path", "index", "width", "height", "palette", "transparent")), strict=True):
                png, written, alpha = picture(bytes(index), int(w), int(h), bytes(palette), None if pd.isna(hole) else int(hole))
                write_atomic(f"{out_dir}/{path}", png)
                palettes.append(written)
                alphas.append(alpha)
            yield frame.drop(columns=["index"]).assign(palette=palettes, has_alpha=alphas).astype({c: "Int64" for c in whole})

    kept = [f for f in bitmaps.schema.fields if f.name != "index"]
    whole = [f.name for f in kept if f.dataType.simpleString() in ("int", "bigint")]
    return bitmaps.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", has_alpha boolean")


def write_palettes(written: DataFrame, out_dir: str) -> int:
    """Writes each distinct palette once, as palettes/<sha256>.json and .png; how many there are."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, palette in zip(frame["name"], frame["palette"], strict=True):
                colours = np.frombuffer(bytes(palette), np.uint8).reshape(256, 3)
                write_atomic(f"{out_dir}/palettes/{name}.json", (json.dumps(colours.tolist(), indent=2) + "\n").encode())
                write_atomic(f"{out_dir}/palettes/{name}.png", raster.png_encode(colours[None]))
            yield frame[["name"]]

    distinct = written.select(F.sha2("palette", 256).alias("name"), "palette").dropDuplicates(["name"])
    return distinct.mapInPandas(run, "name string").count()


def write_nearest(source: np.ndarray, uri: str) -> None:
    """What is not rendered: the source enlarged by nearest neighbour."""
    write_atomic(uri, raster.png_encode(raster.nearest(source)))


def write_errors(errors: Iterable[dict], uri: str) -> None:
    """The error document, only if there are errors; an earlier one goes in any case."""
    delete(uri)
    rows = iter(errors)
    if (first := next(rows, None)) is not None:
        write_parts(uri, chain(json_list(chain([first], rows)), [b"\n"]))
