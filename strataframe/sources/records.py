"""Streams of tagged binary records, as decoders of reference pictures write them, and their comparison with ours."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataframe.sources.container import PALETTE

RECORD = "source string, ord int, type string, width int, height int, transparent int, costume int, cel int, codec int, offset long, reason string, palette binary, index binary, error string"
_FIELDS = [c.split()[0] for c in RECORD.split(", ")]


@dataclass(frozen=True)
class Layout:
    """A picture record: its tag, the little-endian numbers after it with their names, whether a palette comes next."""

    tag: bytes
    numbers: str
    names: tuple[str, ...]
    palette: bool
    type: str

    def read(self, data: bytes, at: int) -> tuple[dict, int] | None:
        """(fields, where the next record starts), or None if the data end before."""
        head = struct.Struct("<" + self.numbers)
        start = at + len(self.tag) + head.size
        if start > len(data):
            return None
        out = {"type": self.type} | dict(zip(self.names, head.unpack_from(data, at + len(self.tag)), strict=True))
        if self.palette:
            out["palette"], start = data[start : start + PALETTE], start + PALETTE
        end = start + out["width"] * out["height"]
        if end > len(data):
            return None
        return out | {"index": data[start:end]}, end


#: The picture records of the four kinds of streams.
LAYOUTS = {
    "frames": Layout(b"FRMK", "HH", ("width", "height"), True, "frame"),
    "glyphs": Layout(b"NUTG", "HHB", ("width", "height", "transparent"), True, "glyph"),
    "bitmaps": Layout(b"LA1B", "HHB", ("width", "height", "transparent"), True, "bitmap"),
    "cels": Layout(b"AKOS", "IHHHB", ("costume", "cel", "width", "height", "transparent"), False, "cel"),
}
_BITMAP_ERROR, _CEL_ERROR = b"LA1E", b"AKOSE"


def _error_record(kind: str, data: bytes, at: int) -> tuple[dict, int] | None:
    """Error records: a bitmap's reason runs to the next tag; a cel's is only tried where no whole cel starts."""
    if kind == "bitmaps" and data.startswith(_BITMAP_ERROR, at) and at + 8 <= len(data):
        ends = [e for tag in (LAYOUTS[kind].tag, _BITMAP_ERROR) if (e := data.find(tag, at + 8)) >= 0]
        end = min(ends, default=len(data))
        return {"type": "error", "offset": int.from_bytes(data[at + 4 : at + 8], "little"), "reason": data[at + 8 : end].decode("latin-1")}, end
    if kind == "cels" and data.startswith(_CEL_ERROR, at) and at + 13 <= len(data):
        costume, cel, codec = struct.unpack_from("<IHH", data, at + 5)
        return {"type": "error", "costume": costume, "cel": cel, "codec": codec}, at + 13
    return None


def parse(kind: str, data: bytes) -> Iterator[dict]:
    """Records of a stream in order; what is no record ends it with an error."""
    layout, at = LAYOUTS[kind], 0
    while at < len(data):
        found = layout.read(data, at) if data.startswith(layout.tag, at) else None
        found = found or _error_record(kind, data, at)
        if found is None:
            raise ValueError(f"no whole record at offset {at}: {data[at : at + 4]!r}")
        yield found[0]
        at = found[1]


def scan(streams: DataFrame, kind: str) -> DataFrame:
    """Record rows of streams (source, content), numbered by ord; a broken stream's last row has the error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for source, content in zip(frame["source"], frame["content"], strict=True):
                rows: list[dict] = []
                try:
                    rows.extend(parse(kind, bytes(content)))
                except ValueError as e:
                    rows.append({"error": str(e)})
                if not rows:
                    continue
                table = pd.DataFrame([dict.fromkeys(_FIELDS) | {"source": source, "ord": i} | r for i, r in enumerate(rows)], columns=_FIELDS)
                yield table.astype({c: "Int64" for c in ("ord", "width", "height", "transparent", "costume", "cel", "codec", "offset")})

    return streams.select("source", "content").mapInPandas(run, RECORD)


def decoded(files: DataFrame, decode: Callable[[str], bytes]) -> DataFrame:
    """(source, content, error): the record streams that a decoder gives for files (source), each a call of its own."""

    def one(source: str) -> tuple[str, bytes | None, str | None]:
        try:
            return source, decode(source), None
        except Exception as e:  # a file that the decoder fails on costs only itself
            return source, None, str(e) or type(e).__name__

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([one(s) for s in frame["source"]], columns=["source", "content", "error"])

    return files.select("source").mapInPandas(run, "source string, content binary, error string")


def differences(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(source, type, place, difference) of two tables of records, compared place by place within each source and type.

    Pictures differ by size, transparent colour, palette or index, errors by offset, in this order; a place that one
    side lacks is missing or surplus. Equal records have no row.
    """
    fields = ("width", "height", "transparent", "palette", "index")
    at = F.row_number().over(Window.partitionBy("source", "type").orderBy("ord")) - 1
    side = lambda t, p: t.where("type IS NOT NULL").select("source", "type", at.alias("place"), *[F.col(c).alias(f"{p}_{c}") for c in (*fields, "offset")], F.lit(True).alias(p))
    other = lambda c: ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    picture = F.when(other("width") | other("height"), "size").when(other("transparent"), "transparent").when(other("palette"), "palette").when(other("index"), "index")
    found = F.when(F.col("a").isNull(), "missing").when(F.col("b").isNull(), "surplus").when(F.col("type") == "error", F.when(other("offset"), "offset")).otherwise(picture)
    both = side(ours, "a").join(side(theirs, "b"), ["source", "type", "place"], "full_outer")
    return both.select("source", "type", "place", found.alias("difference")).where("difference IS NOT NULL")


def first_difference(a: bytes, b: bytes) -> int | None:
    """The place of the first byte that differs, or where the shorter one ends; None for equal ones."""
    if a == b:
        return None
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
