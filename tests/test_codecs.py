import random
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataframe.sources import codecs, encoders, frames
from strataframe.sources.encoders import chunk, padded_chunk

PIXELS = st.one_of(st.binary(min_size=1, max_size=200), st.lists(st.tuples(st.integers(0, 255), st.integers(1, 300)), min_size=1, max_size=6).map(lambda r: b"".join(bytes([v]) * n for v, n in r)))


def test_golden_vectors():
    assert codecs.run_length(bytes.fromhex("09420000"), 0, 6).hex() == "424242424200"
    assert codecs.run_length(bytes.fromhex("0F99"), 0, 3).hex() == "999999"
    assert codecs.run_length(bytes.fromhex("0411223344"), 0, 3).hex() == "112233"
    assert codecs.run_length(bytes.fromhex("02AABB0742"), 0, 6).hex() == "aabb42424242"
    line = np.frombuffer(codecs.run_length(bytes.fromhex("04000102"), 0, 3), np.uint8)
    assert list(np.where(line == 0, 0xAA, line)) == [0xAA, 1, 2]
    raster, hole = codecs.glyph(1, bytes([5, 0, 6, 5, 6, 7, 8, 2, 0, 7, 3])[0:1] + b"\x00" + bytes([6, 5, 6, 7, 8, 2, 0, 7, 3]), 4, 2)
    assert raster.ravel().tolist() == [5, 6, 7, 8, 3, 3, 3, 3] and hole == 0
    spans = struct.pack("<HHH", 8, 0, 3) + bytes([10, 11, 12, 13]) + struct.pack("<HHH", 7, 1, 2) + bytes([30, 31, 32])
    raster, hole = codecs.glyph(44, spans, 4, 2)
    assert raster.ravel().tolist() == [10, 11, 12, 13, 2, 30, 31, 32] and hole == 2
    raster, hole = codecs.cel(1, bytes.fromhex("112132"), 0, 2, 2, 16)
    assert raster.ravel().tolist() == [1, 3, 2, 3] and hole == 0


@settings(max_examples=150, deadline=None)
@given(PIXELS)
def test_sequences_round_trip(pixels):
    assert codecs.run_length(encoders.run_length(pixels), 0, len(pixels)) == pixels
    assert codecs.stepped(encoders.stepped(pixels), 0, 8, len(pixels)).tobytes() == pixels
    assert codecs.spread(encoders.spread(pixels), 0, 8, len(pixels)).tobytes() == pixels
    low = bytes(p & 15 for p in pixels)
    assert codecs.nibbles(encoders.nibbles(low, 16), 0, len(low), 16).tobytes() == low
    assert codecs.nibbles(encoders.nibbles(low, 32), 0, len(low), 32).tobytes() == low
    assert codecs.span_rows(encoders.span_rows(pixels, len(pixels), 2), len(pixels), 1, 2).tobytes() == pixels


@pytest.mark.parametrize("code", sorted(codecs.STRIP_CODECS))
def test_every_strip_codec(code):
    rng = random.Random(code)
    bits = code % 10 if code > 1 else 8
    raster = np.array([[rng.randrange(1 << bits) for _ in range(16)] for _ in range(6)], np.uint8)
    codec = codecs.STRIP_CODECS[code]
    parts = []
    for s in (0, 8):
        strip = raster[:, s : s + 8]
        flat = (strip.T if codec.by_column else strip).tobytes()
        encode = {codecs.stepped: lambda p: encoders.stepped(p, bits), codecs.spread: lambda p: encoders.spread(p, bits)}.get(codec.pixels, lambda p: p)
        parts.append(bytes([code]) + encode(flat))
    hole = int(raster[0, 0])
    got, holes = codecs.strips(encoders.block(parts), 16, 6, hole)
    assert holes == codec.holes and np.array_equal(got, np.where(raster == hole, 0, raster) if codec.holes else raster)


def test_damage_is_reported():
    for data in (b"", b"\x09", b"\x04\x11"):
        with pytest.raises(ValueError):
            codecs.run_length(data, 0, 6)
    with pytest.raises(ValueError, match="unsupported"):
        codecs.strips(encoders.block([b"\x86" + bytes(64)]), 8, 8, 255)
    with pytest.raises(ValueError, match="out of range"):
        codecs.strips(chunk(b"SMAP", (99).to_bytes(4, "little") + bytes(8)), 8, 1, 255)
    with pytest.raises(ValueError, match="table overrun"):
        codecs.strips(chunk(b"SMAP", b""), 8, 1, 255)


def test_transparent_colour_moves_to_zero():
    palette = bytes(random.Random(1).randrange(256) for _ in range(768))
    for hole in (255, 0, 7):
        index, colours = codecs.without_transparent_colour(bytes([hole, 5, 6, 0, hole]), palette, hole)
        assert index[0] == index[4] == 0
        for old, new in zip(bytes([5, 6]), index[1:3], strict=True):
            assert palette[3 * old : 3 * old + 3] == colours[3 * new : 3 * new + 3]


def block_data(kind, body, sequence=0, size=0, flags=0, table=0):
    return bytes([kind, table]) + sequence.to_bytes(2, "little") + size.to_bytes(4, "little") + bytes(4) + bytes([flags]) + bytes(3) + body


def test_delta_blocks():
    d = frames.DeltaBlocks(8, 8)
    raw = bytes(range(64))
    assert d.decode(block_data(0, raw, size=64)) == raw
    still = d.decode(block_data(4, b"\x00\x03", sequence=1))
    assert still == raw  # four blocks that stay
    one = d.decode(block_data(3, b"\xff" + bytes(range(100, 116)) + b"\x00\x00\x00", flags=5, sequence=1))
    grid = np.frombuffer(one, np.uint8).reshape(8, 8)
    assert grid[:4, :4].ravel().tolist() == list(range(100, 116)) and one[4:8] == raw[4:8]
    filled = np.frombuffer(d.decode(block_data(3, b"\xfd\x07" + b"\xfe\x01\x02\x03\x04" + b"\xfd\x08\xfd\x09", flags=4)), np.uint8).reshape(8, 8)
    assert (filled[:4, :4] == 7).all() and filled[:4, 4:].tolist() == [[1, 1, 2, 2]] * 2 + [[3, 3, 4, 4]] * 2
    rows = np.frombuffer(d.decode(block_data(4, b"\xfe\x01\x02\x03\x04" + b"\xfd\x05" * 3, flags=4)), np.uint8).reshape(8, 8)
    assert rows[:4, :4].tolist() == [[k] * 4 for k in (1, 2, 3, 4)]
    runs = d.decode(block_data(1, bytes([7, 0]), sequence=1))  # one run of four blocks that stay
    assert runs == rows.tobytes()
    mixed = d.decode(block_data(1, bytes([0, 0xFF, 31, 9, 5, 0]), sequence=1))  # a literal of one run of colours, then a run of blocks
    assert np.frombuffer(mixed, np.uint8).reshape(8, 8)[:4, :4].tolist() == [[9] * 4] * 4
    assert d.decode(block_data(9, b"")) == mixed
    moved = frames.DeltaBlocks(8, 8, [(4, 0), (0, 0)] + [(0, 4)] * 253)
    moved.decode(block_data(0, raw, size=64))
    shifted = np.frombuffer(moved.decode(block_data(3, b"\x00\x01\x01\x01", sequence=1)), np.uint8).reshape(8, 8)
    assert (shifted[:4, :4] == np.arange(64).reshape(8, 8)[:4, 4:]).all()
    big = frames.DeltaBlocks()
    assert big.decode(block_data(2, bytes.fromhex("0F77"), size=8))[:10] == b"\x77" * 8 + b"\x00\x00"
    with pytest.raises(ValueError):
        d.decode(block_data(3, b"\x01", sequence=1))


def animation(*chunks, announced=None, palette=bytes([100]) * 768):
    head = padded_chunk(b"AHDR", struct.pack("<HH", 2, len(chunks) if announced is None else announced) + b"\x00\x00" + palette)
    return b"ANIM" + (0).to_bytes(4, "big") + head + b"".join(padded_chunk(b"FRME", c) for c in chunks)


def fade(command, deltas=0, palette=b""):
    return padded_chunk(b"XPAL", b"\x00\x00" + command.to_bytes(2, "little") + struct.pack("<768h", *[deltas] * 768) + palette)


def test_palettes_fade_and_frames_repeat():
    rows = list(frames.frames_of(animation(fade(0, 128), fade(256), fade(256) + padded_chunk(b"XYZW", b"1"), b"", fade(0, -128), fade(256)), "a.san"))
    assert [r["palette"][0] for r in rows] == [100, 101, 102, 102, 102, 101] and rows[-1]["notes"] == {"XYZW": 1}
    assert [r["frame"] for r in rows] == list(range(6)) and not any(r["error"] for r in rows)


def test_damaged_animation_keeps_what_came_before():
    data = animation(b"", b"", announced=3)
    assert [r["frame"] for r in frames.frames_of(data, "a")] == [0, 1] and list(frames.frames_of(data, "a"))[-1]["notes"] == {"FRAME_COUNT_MISMATCH": 1}
    bad = list(frames.frames_of(animation(b"", b"") + b"JUNK\x00\x00\x00\x00", "a"))
    assert [r["frame"] for r in bad] == [0, 1, None] and "unknown chunk" in bad[-1]["error"]
    small = padded_chunk(b"FOBJ", struct.pack("<HhhHHHH", 37, 0, 0, 8, 8, 0, 0)) + padded_chunk(b"FOBJ", struct.pack("<HhhHHHH", 37, 0, 0, 400, 8, 0, 0))
    assert list(frames.frames_of(animation(small), "a"))[-1]["notes"] == {"skip_small": 1, "skip_big": 1}
    wrong = list(frames.frames_of(animation(b"", padded_chunk(b"FOBJ", struct.pack("<HhhHHHH", 5, 0, 0, 320, 200, 0, 0))), "a"))
    assert [r["frame"] for r in wrong] == [0, None] and "unsupported codec 5" in wrong[-1]["error"]
    assert [r["error"] for r in frames.frames_of(b"nope", "a")] == ["missing ANIM"]
