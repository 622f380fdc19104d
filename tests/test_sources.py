import random
import struct

import pytest

from strataframe.operators import manifest
from strataframe.sources import codecs, container, encoders, frames
from strataframe.sources.encoders import chunk, padded_chunk
from strataframe.streaming import frames as streaming
from tests.test_codecs import animation, fade


def raw_strips(pixels, width):
    rows = [pixels[i : i + width] for i in range(0, len(pixels), width)]
    return encoders.block([b"\x01" + b"".join(r[x : x + 8] for r in rows) for x in range(0, width, 8)])


def palette_table(colours):
    return chunk(b"PALS", chunk(b"WRAP", chunk(b"OFFS", (12).to_bytes(4, "little")) + chunk(b"APAL", colours)))


def archive(rooms):
    """rooms: list of (number, chunks inside ROOM, chunks after ROOM)."""
    at, body, entries = 8 + 8 + 1 + 5 * len(rooms), b"", b""
    for number, inside, after in rooms:
        lflf = chunk(b"LFLF", chunk(b"ROOM", inside) + after)
        entries += bytes([number]) + (at + len(body) + 8).to_bytes(4, "little")
        body += lflf
    return chunk(b"LECF", chunk(b"LOFF", bytes([len(rooms)]) + entries) + body)


COLOURS = bytes(random.Random(2).randrange(256) for _ in range(768))
PIXELS = bytes(range(1, 17))


def sample_room(number, bad=False):
    head = chunk(b"RMHD", bytes(4) + struct.pack("<HH", 8, 2))
    backdrop = chunk(b"RMIM", chunk(b"IM00", encoders.block([b"\x86" + bytes(16)]) if bad else raw_strips(PIXELS, 8)))
    bomp = chunk(b"BOMP", struct.pack("<2xHH4x", 8, 1) + encoders.run_length_rows(bytes(range(1, 9)), 8))
    obj = chunk(b"OBIM", chunk(b"IMHD", bytes(4) + struct.pack("<H2xhhHH", 63, -16, 24, 8, 1)) + chunk(b"IM01", bomp) + chunk(b"IM0F", chunk(b"WHAT", b"")))
    return number, head + chunk(b"TRNS", b"\x05") + palette_table(COLOURS) + backdrop + obj, b""


def costume(codec, pixels, w, h):
    data = {1: encoders.nibbles(b"".join(pixels[x::w] for x in range(w)), 16), 5: encoders.run_length_rows(pixels, w), 16: b"\x08" + encoders.spread(pixels), 9: b""}[codec]
    return chunk(b"AKOS", chunk(b"AKHD", bytes(6) + struct.pack("<HH", 1, codec)) + chunk(b"AKOF", struct.pack("<IH", 0, 0)) + chunk(b"AKCI", struct.pack("<HH", w, h)) + chunk(b"AKCD", data + bytes(4)) + chunk(b"AKPL", bytes(16)))


def test_archive_rows():
    rows = list(container.archive_rows(archive([sample_room(5), sample_room(6, bad=True)]), "a.la1"))
    good, bomp, unknown, bad = rows[0], rows[1], rows[2], rows[3]
    assert (good["name"], good["index"], good["width"], good["height"], good["transparent"], good["x"], good["palette"]) == ("room005", PIXELS, 8, 2, None, None, COLOURS)
    assert (bomp["name"], bomp["x"], bomp["y"], bomp["transparent"], bomp["index"]) == ("obj063_01", -16, 24, 255, bytes(range(1, 9)))
    assert (unknown["name"], unknown["error"]) == ("obj063_0F", "unknown OBIM image container")
    assert (bad["room"], bad["error"], bad["index"]) == (6, "unsupported SMAP codec", None) and len(rows) == 6


def test_costumes_are_numbered_through_the_file():
    pixels = bytes([0, 3, 3, 7, 9, 0, 1, 1])
    after = costume(1, pixels, 4, 2) + costume(5, pixels, 4, 2)
    rows = [r for r in container.archive_rows(archive([(1, b"", after), (2, b"", costume(16, pixels, 4, 2) + costume(9, pixels, 4, 2))]), "a") if r["family"] == "cel"]
    assert [(r["name"], r["index"], r["error"]) for r in rows] == [("costume001_000", pixels, None), ("costume002_000", pixels, None), ("costume003_000", pixels, None), ("costume004_000", None, "unsupported AKOS codec 9")]
    assert [r["transparent"] for r in rows] == [0, 255, 255, None] and rows[0]["palette"] == bytes(768)


@pytest.mark.parametrize(("data", "reason"), [(b"", "missing LECF"), (b"LECF" + (99).to_bytes(4, "big") + bytes(20), "overruns"), (chunk(b"LECF", chunk(b"XXXX", bytes(9))), "missing LOFF"), (chunk(b"LECF", chunk(b"LOFF", b"\x01\x07" + (9999).to_bytes(4, "little"))), "out of range"), (chunk(b"LECF", chunk(b"LOFF", b"\x01\x07" + (8).to_bytes(4, "little"))), "not ROOM")])
def test_broken_directories(data, reason):
    with pytest.raises(codecs.DecodeError, match=reason):
        list(container.archive_rows(data, "a"))


def font(*glyphs, count=None):
    head = padded_chunk(b"AHDR", struct.pack("<HH", 2, len(glyphs) if count is None else count) + b"\x00\x00" + COLOURS)
    body = b"".join(padded_chunk(b"FRME", padded_chunk(b"FOBJ", struct.pack("<H4xHH4x", codec, w, h) + data)) for codec, w, h, data in glyphs)
    return b"ANIM" + len(head + body).to_bytes(4, "big") + head + body


def test_font_rows():
    one = encoders.run_length_rows(bytes([5, 6, 7, 8, 3, 3, 3, 3]), 4)
    rows = list(container.font_rows(font((1, 4, 2, one), (44, 4, 2, encoders.span_rows(bytes([10, 2, 2, 13, 2, 30, 31, 2]), 4, 2))), "x/Font0.NUT"))
    assert [(r["name"], r["transparent"], list(r["index"])) for r in rows] == [("font0:000", 0, [5, 6, 7, 8, 3, 3, 3, 3]), ("font0:001", 2, [10, 2, 2, 13, 2, 30, 31, 2])]
    with pytest.raises(codecs.DecodeError, match="unknown NUT codec 7"):
        list(container.font_rows(font((7, 4, 2, one)), "f"))
    with pytest.raises(codecs.DecodeError, match="no whole glyph 1"):
        list(container.font_rows(font((1, 4, 2, one), count=2), "f"))


def test_scans(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "A.LA1").write_bytes(archive([sample_room(5), sample_room(6, bad=True)]))
    (tmp_path / "sub" / "B.LA1").write_bytes(b"junk")
    (tmp_path / "f.NUT").write_bytes(font((1, 4, 1, encoders.run_length_rows(b"\x01\x02\x03\x04", 4)), (9, 1, 1, b"")))
    found = container.scan(spark, str(tmp_path), "archive", "*.LA1").select("source", "name", "error").collect()
    assert sorted((r.source[-5:], r.name, r.error) for r in found if r.error) == [("A.LA1", "obj063_0F", "unknown OBIM image container")] * 2 + [("A.LA1", "room006", "unsupported SMAP codec"), ("B.LA1", None, "missing LECF")]
    glyphs = container.scan(spark, str(tmp_path), "font", "*.NUT").select("name", "error").collect()
    assert [(r.name, r.error) for r in glyphs] == [("f:000", None), (None, "unknown NUT codec 9")]
    spark.dataSource.register(container.ArchiveSource)
    by_room = spark.read.format("image_archive").option("path", f"file://{tmp_path}/A.LA1").load()
    assert by_room.rdd.getNumPartitions() == 2
    whole = container.scan(spark, str(tmp_path), "archive", "A.LA1")
    key = lambda df: sorted((r.room, r.name, r.offset, r.error, r["index"]) for r in df.collect())
    assert key(by_room) == key(whole)


def test_chunk_tree(spark, tmp_path):
    data = archive([sample_room(5), (6, b"", costume(1, bytes(8), 4, 2) + b"??")])
    (tmp_path / "A.LA1").write_bytes(data)
    rows = container.scan_chunks(spark, str(tmp_path)).collect()
    tags = [r.tag for r in rows if not r.desync]
    assert tags[0] == "LECF" and tags.count("ROOM") == 2 and {"RMHD", "IM00", "SMAP", "IMHD", "BOMP", "APAL", "AKCD"} <= set(tags)
    assert [(r.tag, r.size) for r in rows if r.desync] == [("??", 2)]
    by_off = {r.off: r for r in rows}
    assert all(r.parent == -1 or by_off[r.parent].off < r.off < by_off[r.parent].off + by_off[r.parent].size for r in rows)
    assert sum(r[-1] for r in container.chunk_tree(data[:-1], "a")) and any(r[-1] for r in container.chunk_tree(chunk(b"LECF", chunk(b"ABCD", b"1") + chunk(b"ABCD", b"1")), "a", padded=True))
    classes = spark.createDataFrame([("ROOM", "room", "a place")], "tag string, class string, note string")
    df = container.scan_chunks(spark, str(tmp_path)).where("NOT desync")
    got = {(r.tag, r["class"], r.note) for r in manifest.classified(df, classes).collect()}
    assert ("ROOM", "room", "a place") in got and ("SMAP", "unknown", "unclassified") in got
    assert {r.depth: r.line for r in manifest.histogram_text(df, "depth", "tag").collect()}[0] == "{LECF: 1}"


def test_chunk_function(spark):
    container.register_chunks(spark)
    data = chunk(b"AAAA", b"12345") + chunk(b"BBBB", b"") + b"\x00rest"
    even = padded_chunk(b"AAAA", b"12345") + padded_chunk(b"BBBB", b"x")
    spark.createDataFrame([(1, data, True, False), (2, even, False, True), (3, None, True, False)], "id int, content binary, h boolean, p boolean").createOrReplaceTempView("blobs")
    got = spark.sql("SELECT id, c.tag, c.off, c.size, c.ord FROM blobs, LATERAL chunks(content, h, p) c ORDER BY id, ord").collect()
    assert list(map(tuple, got)) == [(1, "AAAA", 0, 13, 0), (1, "BBBB", 13, 8, 1), (2, "AAAA", 0, 5, 0), (2, "BBBB", 14, 1, 1)]


def test_frames_in_batch_and_stream_agree(spark, tmp_path):
    payloads = [fade(0, 128), fade(256), b"", fade(256), fade(0, -256), fade(256)]
    rows = [(s, i, p) for s in ("a", "b") for i, p in enumerate(payloads[: 6 if s == "a" else 3])]
    schema = "source string, frame int, payload binary"
    batch = streaming.folded(spark.createDataFrame(rows[::-1], schema)).collect()
    for k, part in enumerate((rows[:2] + rows[6:8], rows[2:6] + rows[8:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    query = streaming.streamed(stream).writeStream.format("memory").queryName("frames_out").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    out = spark.table("frames_out").collect()
    key = lambda rs: sorted((r.source, r.frame, r.palette, r.error) for r in rs)
    assert key(out) == key(batch) and len(out) == 9
    files = [("x.san", animation(*payloads))]
    scanned = frames.scan_frames(spark.createDataFrame(files, "path string, content binary")).collect()
    assert [r.frame for r in scanned] == list(range(6)) and scanned[-1].error is None
