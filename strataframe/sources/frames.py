"""Animations: frames that depend on those before, folded file by file or as a stream keyed by source."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from strataframe.sources import codecs
from strataframe.sources.codecs import DecodeError, u16
from strataframe.sources.container import PALETTE, u32be
from strataframe.sources.tables import read_text

WIDTH, HEIGHT = 320, 200
#: Where the two pictures lie in the decoder's memory, which blocks may reach outside of them.
FIRST, SECOND, SLACK = 0x4D80, 0xE880, 0x13600
FRAMES = "source string, frame int, index binary, palette binary, notes map<string,int>, offset long, error string"


def ring_displacements(tables: int = 3) -> list[tuple[int, int]]:
    """255 displacements (dx, dy) a table, by distance from (0, 0), each table reaching twice as far as the one before.

    A stand-in by rule: a format's own table is data, to be passed in its place.
    """
    near = sorted(((x, y) for x in range(-8, 9) for y in range(-8, 9)), key=lambda d: (max(map(abs, d)), d[1], d[0]))[:255]
    return [(x << t, y << t) for t in range(tables) for x, y in near]


def read_displacements(uri: str) -> list[tuple[int, int]]:
    """A format's own displacements from a file: lines of dx and dy, 255 a table; what it holds besides is an error."""
    text = read_text(uri)
    if text is None:
        raise ValueError(f"{uri}: there is no such file")
    out = [tuple(map(int, line.replace(",", " ").split())) for line in text.splitlines() if line.strip()]
    if not out or len(out) % 255 or any(len(d) != 2 for d in out):
        raise ValueError(f"{uri}: tables are 255 lines of two numbers each")
    return out


class _Runs:
    """Items of a stream of runs: a control byte counts items, which are all one (lowest bit 1) or each their own."""

    def __init__(self, data: bytes, at: int):
        self.data, self.at, self.left, self.same, self.value = data, at, -1, False, 0

    def _read(self) -> int:
        if self.at >= len(self.data):
            raise ValueError("the blocks are cut off")
        self.at += 1
        return self.data[self.at - 1]

    def next(self) -> int:
        fresh = self.left < 0
        if fresh:
            control = self._read()
            self.same, self.left = bool(control & 1), control >> 1
        self.left -= 1
        if self.same and not fresh:
            return self.value
        value = self._read()
        if self.same:
            self.value = value
        return value


def _run_actions(data: bytes) -> Iterator[int | bytes]:
    runs = _Runs(data, 16)
    while True:
        code = runs.next()
        yield bytes(runs.next() for _ in range(16)) if code == 0xFF else code


def _coded_actions(data: bytes, short: bool, still_runs: bool) -> Iterator[int | bytes]:
    """short: codes FD and FE are literals of one and four colours; still_runs: code 0 repeats a block that stays."""
    at = 16

    def literal(n: int) -> bytes:
        if at + 1 + n > len(data):
            raise ValueError("the blocks are cut off")
        return data[at + 1 : at + 1 + n]

    while True:
        if at >= len(data):
            raise ValueError("the blocks are cut off")
        code = data[at]
        if code == 0xFF:
            yield literal(16)
            at += 17
        elif short and code == 0xFD:
            yield literal(1) * 16
            at += 2
        elif short and code == 0xFE:
            four = literal(4)
            rows = [four[i : i + 1] * 4 for i in range(4)] if still_runs else [four[i : i + 1] * 2 + four[i + 1 : i + 2] * 2 for i in (0, 0, 2, 2)]
            yield b"".join(rows)
            at += 5
        elif still_runs and code == 0:
            for _ in range(literal(1)[0] + 1):
                yield -1
            at += 2
        else:
            yield code
            at += 1


@dataclass
class DeltaBlocks:
    """Pictures of 4 by 4 blocks: copies from the other picture, displaced, or literals."""

    width: int = WIDTH
    height: int = HEIGHT
    displacements: Sequence[tuple[int, int]] = field(default_factory=ring_displacements)

    def __post_init__(self):
        self.pitch, self.rows = (self.width + 3) // 4 * 4, (self.height + 3) // 4
        self.size = self.width * self.height
        self.memory = np.zeros(self.size * 3 + SLACK, np.uint8)
        self.bases, self.current = (FIRST, SECOND + self.size), 0

    def _only(self, content: bytes) -> None:
        base = self.bases[self.current]
        self.memory[:] = 0
        self.memory[base : base + len(content)] = np.frombuffer(content, np.uint8)

    def _paint(self, actions: Iterator[int | bytes], table: int) -> None:
        base, other = self.bases[self.current], self.bases[1 - self.current]
        cells = np.add.outer(np.arange(4) * self.pitch, np.arange(4))
        for row in range(self.rows):
            for at in range(row * 4 * self.pitch, row * 4 * self.pitch + self.pitch, 4):
                action = next(actions)
                if isinstance(action, bytes):
                    block = np.frombuffer(action, np.uint8).reshape(4, 4)
                else:
                    dx, dy = self.displacements[table * 255 + action] if action >= 0 else (0, 0)
                    block = self.memory[other + at + dy * self.pitch + dx + cells]
                self.memory[base + at + cells] = block

    def decode(self, data: bytes) -> bytes:
        """The picture after one more piece of data; kinds of data that are not known change nothing."""
        if len(data) < 16:
            raise ValueError("the block header is cut off")
        kind, table, sequence, size, flags = data[0], data[1], u16(data, 2), int.from_bytes(data[4:8], "little"), data[12]
        if kind == 0:
            self._only(data[16 : 16 + size])
        elif kind == 2:
            self._only(codecs.run_length(data, 16, size))
        elif kind in (1, 3, 4):
            if sequence & 1 or not flags & 1:
                self.current = 1 - self.current
            actions = _run_actions(data) if kind == 1 else _coded_actions(data, bool(flags & 4), kind == 4)
            self._paint(actions, table)
        base = self.bases[self.current]
        return self.memory[base : base + self.size].tobytes()


@dataclass
class FrameState:
    """All that a frame inherits: palette, its deltas in 1/128, picture, decoder, counts of what was passed over."""

    source: str
    displacements: Sequence[tuple[int, int]] = field(default_factory=ring_displacements)

    def __post_init__(self):
        self.palette = np.zeros(PALETTE, np.int64)
        self.fine, self.delta = np.zeros(PALETTE, np.int64), np.zeros(PALETTE, np.int64)
        self.index, self.notes, self.blocks = bytes(WIDTH * HEIGHT), {}, None

    def note(self, what: str, n: int = 1) -> None:
        self.notes[what] = self.notes.get(what, 0) + n

    def set_palette(self, colours: bytes) -> None:
        if len(colours) < PALETTE:
            raise ValueError("the palette is cut off")
        self.palette = np.frombuffer(colours[:PALETTE], np.uint8).astype(np.int64)

    def fade(self, payload: bytes) -> None:
        """Command 256 adds the deltas; others load them, and 512 sets the palette as well."""
        command = u16(payload, 2)
        if command == 256:
            self.fine = self.fine + self.delta
            self.palette = np.clip(self.fine >> 7, 0, 255)
            return
        self.fine = self.palette << 7
        self.delta = np.frombuffer(payload[4 : 4 + 2 * PALETTE].ljust(2 * PALETTE, b"\x00"), "<i2").astype(np.int64)
        if command == 512:
            self.set_palette(payload[4 + 2 * PALETTE :])

    def picture(self, payload: bytes, offset: int) -> None:
        if len(payload) < 14:
            raise DecodeError(self.source, offset, f"FOBJ payload too small {len(payload)}")
        codec, w, h = u16(payload, 0), u16(payload, 6), u16(payload, 8)
        if w > WIDTH or h > HEIGHT:
            return self.note("skip_big")
        if (w, h) != (WIDTH, HEIGHT):
            return self.note("skip_small")
        if codec != 37:
            raise DecodeError(self.source, offset, f"unsupported codec {codec}")
        self.blocks = self.blocks or DeltaBlocks(displacements=self.displacements)
        self.index = self.blocks.decode(payload[14:])

    def feed(self, frame: bytes, offset: int = 0) -> tuple[bytes, bytes]:
        """(index, palette) after one more frame's chunks; a frame that changes nothing repeats both."""
        at = 0
        while at + 8 <= len(frame):
            tag, size = frame[at : at + 4], u32be(frame, at + 4)
            payload = frame[at + 8 : at + 8 + size]
            if tag == b"NPAL":
                self.set_palette(payload)
            elif tag == b"XPAL":
                self.fade(payload)
            elif tag == b"FOBJ":
                self.picture(payload, offset + at)
            else:
                self.note(tag.decode("latin-1"))
            at += 8 + size + (size & 1)
        return self.index, self.palette.astype(np.uint8).tobytes()


def frames_of(data: bytes, source: str, displacements: Sequence[tuple[int, int]] | None = None) -> Iterator[dict]:
    """Rows of an animation's frames; damage ends it with an error row that keeps what came before."""
    state = FrameState(source, displacements or ring_displacements())
    row = lambda **x: dict.fromkeys(("source", "frame", "index", "palette", "notes", "offset", "error")) | {"source": source} | x
    at, n, announced, last = 8, 0, None, None
    try:
        if data[:4] != b"ANIM":
            raise DecodeError(source, 0, "missing ANIM")
        while at + 8 <= len(data):
            tag, size, body = data[at : at + 4], u32be(data, at + 4), at + 8
            if body + size > len(data):
                raise DecodeError(source, at, f"bad {tag!r} chunk size {size}")
            if tag == b"AHDR":
                if size < 6 + PALETTE or u16(data, body) != 2:
                    raise DecodeError(source, body, "bad AHDR")
                announced = u16(data, body + 2)
                state.set_palette(data[body + 6 : body + 6 + PALETTE])
            elif tag == b"FRME":
                if last is not None:
                    yield last
                    last = None
                index, palette = state.feed(data[body : body + size], body)
                last, n = row(frame=n, index=index, palette=palette, offset=at), n + 1
            else:
                raise DecodeError(source, at, f"unknown chunk {tag!r}")
            at = body + size + (size & 1)
        if announced is not None and announced != n:
            state.note("FRAME_COUNT_MISMATCH", announced - n)
        if last is not None:
            yield last | {"notes": state.notes}
    except Exception as e:  # a file of any damage costs only what follows it
        if last is not None:
            yield last
        yield row(offset=getattr(e, "offset", at), error=getattr(e, "reason", str(e) or type(e).__name__), notes=state.notes)


def scan_frames(files: DataFrame, displacements: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """Frame and error rows of files (path, content), a file at a time in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                part: list[dict] = []
                for r in frames_of(bytes(content), path, displacements):
                    part.append(r)
                    if len(part) == 100:
                        yield _frame(part)
                        part = []
                if part:
                    yield _frame(part)

    return files.select("path", "content").mapInPandas(run, FRAMES)


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in FRAMES.split(", ")]).astype({"frame": "Int64", "offset": "Int64"})
