"""Image codecs: compressed bytes to index rasters, as plain functions over bytes and numpy arrays.

Each codec is a decoder of a pixel sequence plus a way of laying the sequence out. The registry of strip codecs maps
the code byte to both; a strip that its codec paints with holes comes with the mask of what it paints.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


#: Reasons that error rows give.
REASONS = {
    "strip codec": "unsupported SMAP codec",
    "strip table": "SMAP strip table overrun",
    "strip offset": "SMAP strip offset out of range",
    "cel codec": "unsupported AKOS codec {}",
    "glyph codec": "unknown NUT codec {}",
    "row image size": "BOMP dimensions disagree with IMHD",
    "object image": "unknown OBIM image container",
}


class DecodeError(ValueError):
    """What could not be decoded: source, offset of the resource, reason."""

    def __init__(self, source: str, offset: int, reason: str):
        super().__init__(f"{source}@{offset}: {reason}")
        self.source, self.offset, self.reason = source, offset, reason


class Bits:
    """Little-endian bit stream: the least significant bit of each byte comes first."""

    def __init__(self, data: bytes, at: int):
        self.data, self.at, self.end = data, at * 8, len(data) * 8

    def take(self, n: int) -> int:
        if self.at + n > self.end:
            raise ValueError("the bit stream is cut off")
        byte, skip = divmod(self.at, 8)
        self.at += n
        return int.from_bytes(self.data[byte : byte + 3], "little") >> skip & ((1 << n) - 1)


def _byte(data: bytes, at: int) -> int:
    if at >= len(data):
        raise ValueError("the data are cut off")
    return data[at]


def u16(data: bytes, at: int) -> int:
    if at + 2 > len(data):
        raise ValueError("the data are cut off")
    return int.from_bytes(data[at : at + 2], "little")


# ---- pixel sequences ---------------------------------------------------------------------------


def run_length(data: bytes, at: int, size: int) -> bytes:
    """size pixels of runs and literals: a control byte holds the count less one above its lowest bit, 1 for a run."""
    out = bytearray()
    while len(out) < size:
        control = _byte(data, at)
        count = min((control >> 1) + 1, size - len(out))
        if control & 1:
            out += bytes([_byte(data, at + 1)]) * count
            at += 2
        else:
            part = data[at + 1 : at + 1 + count]
            if len(part) < count:
                raise ValueError("a literal is cut off")
            out += part
            at += 1 + count
    return bytes(out)


def stepped(data: bytes, at: int, shift: int, count: int) -> np.ndarray:
    """count pixels of a colour that stays, steps by one along a direction that can turn, or is set anew by shift bits."""
    colour, direction = _byte(data, at), -1
    bits, out = Bits(data, at + 1), np.empty(count, np.uint8)
    for i in range(count):
        out[i] = colour
        if i + 1 == count or not bits.take(1):
            continue
        if not bits.take(1):
            colour, direction = bits.take(shift), -1
        else:
            if bits.take(1):
                direction = -direction
            colour = (colour + direction) & 0xFF
    return out


def spread(data: bytes, at: int, shift: int, count: int) -> np.ndarray:
    """count pixels of a colour that stays, moves by -4 to 3, repeats for a counted run, or is set anew by shift bits.

    A counted run of one or none has no end.
    """
    colour, bits, out, i = _byte(data, at), Bits(data, at + 1), np.empty(count, np.uint8), 0
    while i < count:
        out[i] = colour
        i += 1
        if i == count or not bits.take(1):
            continue
        if not bits.take(1):
            colour = bits.take(shift)
            continue
        move = bits.take(3)
        if move != 4:
            colour = (colour + move - 4) & 0xFF
            continue
        run = bits.take(8) - 1
        stop = min(count, i + run) if run > 0 else count
        out[i:stop] = colour
        i = stop
    return out


def nibbles(data: bytes, at: int, count: int, colours: int) -> np.ndarray:
    """count pixels of (colour, run) bytes; how a byte splits depends on the number of colours, a run of 0 is in the next."""
    shift = {32: 3, 64: 2}.get(colours, 4)
    out, i = np.zeros(count, np.uint8), 0
    while i < count:
        control = _byte(data, at)
        run = control & ((1 << shift) - 1)
        at += 1
        if not run:
            run, at = _byte(data, at) or 256, at + 1
        out[i : i + run] = control >> shift
        i += run
    return out


# ---- rasters -----------------------------------------------------------------------------------


def run_length_rows(data: bytes, at: int, width: int, height: int, over: int | None = None) -> np.ndarray:
    """Rows of run_length, each after its length in 16 bits; with over, pixels of 0 show that colour."""
    out = np.empty((height, width), np.uint8)
    for row in out:
        size = u16(data, at)
        row[:] = np.frombuffer(run_length(data, at + 2, width), np.uint8)
        at += 2 + size
    return out if over is None else np.where(out == 0, np.uint8(over), out)


def span_rows(data: bytes, width: int, height: int, background: int) -> np.ndarray:
    """Rows of (skip, count less one, pixels) spans in 16 bits, each row after its length; a span ends with its row."""
    out, at = np.full((height, width), background, np.uint8), 0
    for row in out:
        after, x, p = at + 2 + u16(data, at), 0, at + 2
        while x < width:
            x, p = x + u16(data, p), p + 2
            if x >= width:
                break
            count, p = u16(data, p) + 1, p + 2
            shown = data[p : p + min(count, width - x)]
            row[x : x + len(shown)] = np.frombuffer(shown, np.uint8)
            x, p = x + count, p + len(shown)
        at = after
    return out


def column_runs(data: bytes, at: int, width: int, height: int, colours: int) -> np.ndarray:
    return nibbles(data, at, width * height, colours).reshape(width, height).T.copy()


@dataclass(frozen=True)
class StripCodec:
    name: str
    pixels: object  # (data, at, shift, count) -> sequence
    by_column: bool
    holes: bool


def _raw(data: bytes, at: int, shift: int, count: int) -> np.ndarray:
    if at + count > len(data):
        raise ValueError("the data are cut off")
    return np.frombuffer(data[at : at + count], np.uint8)


#: Codes of the strip codecs; the last digit of all but the first is the number of bits of a new colour.
STRIP_CODECS = {1: StripCodec("raw", _raw, False, False)}
for _first, _codec in {
    14: StripCodec("stepped by column", stepped, True, False),
    24: StripCodec("stepped", stepped, False, False),
    34: StripCodec("stepped by column, holes", stepped, True, True),
    44: StripCodec("stepped, holes", stepped, False, True),
    64: StripCodec("spread", spread, False, False),
    84: StripCodec("spread, holes", spread, False, True),
    104: StripCodec("spread again", spread, False, False),
    124: StripCodec("spread again, holes", spread, False, True),
}.items():
    STRIP_CODECS |= {_first + i: _codec for i in range(5)}


def strip(data: bytes, at: int, height: int, transparent: int) -> tuple[np.ndarray, np.ndarray | None]:
    """The 8 by height raster of a strip, and the mask of what it paints if its codec leaves holes."""
    codec = STRIP_CODECS.get(_byte(data, at))
    if codec is None:
        raise ValueError(REASONS["strip codec"])
    found = codec.pixels(data, at + 1, data[at] % 10, 8 * height)
    raster = found.reshape(8, height).T if codec.by_column else found.reshape(height, 8)
    return raster, (raster != transparent) if codec.holes else None


def strips(block: bytes, width: int, height: int, transparent: int) -> tuple[np.ndarray, bool]:
    """The raster of a block (tag, size, strip offsets, strips), and whether any strip can have holes; holes are 0."""
    size = int.from_bytes(block[4:8], "big")
    out, holes = np.zeros((height, width), np.uint8), False
    for s in range(width // 8):
        if s * 4 + 8 >= size:
            raise ValueError(REASONS["strip table"])
        at = int.from_bytes(block[8 + 4 * s : 12 + 4 * s], "little")
        if at >= size:
            raise ValueError(REASONS["strip offset"])
        raster, painted = strip(block, at, height, transparent)
        target = out[:, 8 * s : 8 * s + 8]
        target[:] = raster if painted is None else np.where(painted, raster, target)
        holes |= painted is not None
    return out, holes


def cel(codec: int, data: bytes, at: int, width: int, height: int, colours: int) -> tuple[np.ndarray, int]:
    """(raster, transparent index) of a costume cel; its codecs are 1, 5 and 16."""
    if codec == 1:
        return column_runs(data, at, width, height, colours), 0
    if codec == 5:
        return run_length_rows(data, at, width, height), 255
    if codec == 16:
        return spread(data, at + 1, _byte(data, at), width * height).reshape(height, width), 255
    raise ValueError(REASONS["cel codec"].format(codec))


def glyph(codec: int, data: bytes, width: int, height: int) -> tuple[np.ndarray, int]:
    """(raster, transparent index) of a font glyph; its codecs are 1 and 44."""
    if codec == 1:
        return run_length_rows(data, 0, width, height, over=0), 0
    if codec == 44:
        return span_rows(data, width, height, 2), 2
    raise ValueError(REASONS["glyph codec"].format(codec))


def without_transparent_colour(index: bytes, palette: bytes, transparent: int) -> tuple[bytes, bytes]:
    """index and palette with the transparent colour moved to 0 and what was 0 in its place; opaque pixels look the same."""
    swap = bytearray(range(256))
    swap[0], swap[transparent] = transparent, 0
    colours = [palette[3 * i : 3 * i + 3] for i in range(256)]
    colours[0], colours[transparent] = colours[transparent], colours[0]
    return index.translate(bytes(swap)), b"".join(colours)
