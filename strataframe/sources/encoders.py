"""Encoders of the image codecs, for round trips: simple rather than small."""

from __future__ import annotations

import struct
from itertools import groupby


def run_length(pixels: bytes) -> bytes:
    """Runs of equal pixels, and literals of those that stand alone, at most 128 a control byte."""
    out, alone = bytearray(), bytearray()

    def flush() -> None:
        for i in range(0, len(alone), 128):
            part = alone[i : i + 128]
            out.append((len(part) - 1) << 1)
            out.extend(part)
        alone.clear()

    for value, run in groupby(pixels):
        n = len(list(run))
        if n == 1:
            alone.append(value)
            continue
        flush()
        for i in range(0, n, 128):
            out.extend(((min(128, n - i) - 1) << 1 | 1, value))
    flush()
    return bytes(out)


def run_length_rows(pixels: bytes, width: int) -> bytes:
    rows = [run_length(pixels[i : i + width]) for i in range(0, len(pixels), width)]
    return b"".join(len(r).to_bytes(2, "little") + r for r in rows)


def span_rows(pixels: bytes, width: int, background: int) -> bytes:
    """(skip, count less one, pixels) spans of what is not background; a row without any is one long skip."""
    out = b""
    for i in range(0, len(pixels), width):
        row, spans, skipped = pixels[i : i + width], b"", 0
        for empty, run in groupby(row, lambda p: p == background):
            part = bytes(run)
            if empty:
                skipped = len(part)
                continue
            spans += skipped.to_bytes(2, "little") + (len(part) - 1).to_bytes(2, "little") + part
            skipped = 0
        if skipped:
            spans += skipped.to_bytes(2, "little")
        out += len(spans).to_bytes(2, "little") + spans
    return out


class _Bits:
    def __init__(self):
        self.value, self.size = 0, 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.size
        self.size += n

    def bytes(self) -> bytes:
        return self.value.to_bytes((self.size + 7) // 8 + 2, "little")


def stepped(pixels: bytes, shift: int = 8) -> bytes:
    """Steps where the next colour is one away along the direction or against it, else a new colour."""
    bits, colour, direction = _Bits(), pixels[0], -1
    for p in pixels[1:]:
        if p == colour:
            bits.put(0, 1)
        elif p == (colour + direction) & 0xFF:
            bits.put(0b011, 3)
        elif p == (colour - direction) & 0xFF:
            bits.put(0b111, 3)
            direction = -direction
        else:
            bits.put(0b01, 2)
            bits.put(p, shift)
            direction = -1
        colour = p
    return pixels[:1] + bits.bytes()


def spread(pixels: bytes, shift: int = 8) -> bytes:
    """Counted runs of three and more, moves of -4 to 3, else a new colour."""
    bits, i = _Bits(), 0
    while i + 1 < len(pixels):
        same = next((k for k in range(i + 1, len(pixels)) if pixels[k] != pixels[i]), len(pixels)) - i - 1
        move = (pixels[i + 1] - pixels[i] + 4) & 0xFF
        if same >= 3:  # the pixel after a counted run still has its colour
            run = min(same - 1, 254)
            bits.put(0b11, 2)
            bits.put(4, 3)
            bits.put(run + 1, 8)
            i += run + 1
            continue
        if pixels[i + 1] == pixels[i]:
            bits.put(0, 1)
        elif move < 8 and move != 4:
            bits.put(0b11, 2)
            bits.put(move, 3)
        else:
            bits.put(0b01, 2)
            bits.put(pixels[i + 1], shift)
        i += 1
    return pixels[:1] + bits.bytes()


def nibbles(pixels: bytes, colours: int) -> bytes:
    shift = {32: 3, 64: 2}.get(colours, 4)
    out = bytearray()
    for value, run in groupby(pixels):
        n = len(list(run))
        while n:
            part = min(n, 255)
            out += bytes([value << shift | part]) if part < 1 << shift else bytes([value << shift, part])
            n -= part
    return bytes(out)


def block(strips: list[bytes], tag: bytes = b"SMAP") -> bytes:
    """Strips, each with its code byte, behind their table of offsets."""
    at, table = 8 + 4 * len(strips), b""
    for s in strips:
        table += at.to_bytes(4, "little")
        at += len(s)
    return chunk(tag, table + b"".join(strips))


def chunk(tag: bytes, payload: bytes) -> bytes:
    """A chunk whose size counts its header, not padded."""
    return tag + (8 + len(payload)).to_bytes(4, "big") + payload


def padded_chunk(tag: bytes, payload: bytes) -> bytes:
    """A chunk whose size is that of its payload, padded to an even length."""
    return tag + len(payload).to_bytes(4, "big") + payload + b"\x00" * (len(payload) & 1)


# ---- containers --------------------------------------------------------------------------------


def archive(rooms: list[tuple[int, bytes, bytes]]) -> bytes:
    """An archive of (number, chunks inside the room, chunks after it) with its directory."""
    at, body, entries = 17 + 5 * len(rooms), b"", b""
    for number, inside, after in rooms:
        entries += bytes([number]) + (at + len(body) + 8).to_bytes(4, "little")
        body += chunk(b"LFLF", chunk(b"ROOM", inside) + after)
    return chunk(b"LECF", chunk(b"LOFF", bytes([len(rooms)]) + entries) + body)


def palette_table(colours: bytes) -> bytes:
    return chunk(b"PALS", chunk(b"WRAP", chunk(b"OFFS", (12).to_bytes(4, "little")) + chunk(b"APAL", colours)))


def backdrop(width: int, height: int, transparent: int, strips: bytes, colours: bytes) -> bytes:
    """What a room has of its own: size, transparent colour, palette and a picture of strips."""
    head = chunk(b"RMHD", bytes(4) + struct.pack("<HH", width, height)) + chunk(b"TRNS", bytes([transparent]))
    return head + palette_table(colours) + chunk(b"RMIM", chunk(b"IM00", strips))


def row_image(width: int, height: int, pixels: bytes) -> bytes:
    return chunk(b"BOMP", struct.pack("<2xHH4x", width, height) + run_length_rows(pixels, width))


def room_object(number: int, x: int, y: int, width: int, height: int, images: dict[str, bytes]) -> bytes:
    """An object of a room with its images by the two digits of their state."""
    head = chunk(b"IMHD", bytes(4) + struct.pack("<H2xhhHH", number, x, y, width, height))
    return chunk(b"OBIM", head + b"".join(chunk(f"IM{state}".encode(), image) for state, image in images.items()))


def costume(codec: int, width: int, height: int, data: bytes) -> bytes:
    """A costume of one cel with 16 colours."""
    parts = {b"AKHD": bytes(6) + struct.pack("<HH", 1, codec), b"AKOF": struct.pack("<IH", 0, 0), b"AKCI": struct.pack("<HH", width, height), b"AKCD": data + bytes(4), b"AKPL": bytes(16)}
    return chunk(b"AKOS", b"".join(chunk(tag, body) for tag, body in parts.items()))


def font(glyphs: list[tuple[int, int, int, bytes]], colours: bytes) -> bytes:
    """A font of (codec, width, height, data)."""
    body = padded_chunk(b"AHDR", struct.pack("<HH", 2, len(glyphs)) + b"\x00\x00" + colours)
    for codec, width, height, data in glyphs:
        body += padded_chunk(b"FRME", padded_chunk(b"FOBJ", struct.pack("<H4xHH4x", codec, width, height) + data))
    return b"ANIM" + len(body).to_bytes(4, "big") + body


def animation(frames: list[bytes], colours: bytes) -> bytes:
    """An animation of frames, each its chunks."""
    head = padded_chunk(b"AHDR", struct.pack("<HH", 2, len(frames)) + b"\x00\x00" + colours)
    return b"ANIM" + (0).to_bytes(4, "big") + head + b"".join(padded_chunk(b"FRME", f) for f in frames)


def fade(command: int, delta: int = 0) -> bytes:
    return padded_chunk(b"XPAL", b"\x00\x00" + command.to_bytes(2, "little") + struct.pack("<768h", *[delta] * 768))


def delta_blocks(kind: int, body: bytes, width: int, height: int, sequence: int = 1, size: int = 0, flags: int = 0) -> bytes:
    """A frame's picture of blocks."""
    head = bytes([kind, 0]) + sequence.to_bytes(2, "little") + size.to_bytes(4, "little") + bytes(4) + bytes([flags]) + bytes(3)
    return padded_chunk(b"FOBJ", struct.pack("<HhhHHHH", 37, 0, 0, width, height, 0, 0) + head + body)
