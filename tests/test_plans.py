"""Captions, reviews, services, record streams and the scan by room, with fakes for all that lies outside."""

import json
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.functions import raster, text
from strataframe.operators import attempts
from strataframe.plans import batch, extract, services
from strataframe.sources import container, frames, records
from tests.test_raster import blocks
from tests.test_sources import archive, costume, sample_room


def test_caption_selection_and_captions(spark):
    rows = [("a", False, None), ("b", False, "  "), ("c", False, "SCENE: x"), ("d", True, "")]
    df = spark.createDataFrame(rows, "key string, skip boolean, caption string")
    pick = lambda force: sorted(r.key for r in df.where(attempts.wants_caption(F.col("skip"), F.col("caption"), force)).collect())
    assert pick(False) == ["a", "b"] and pick(True) == ["a", "b", "c"]
    png = raster.png_encode(blocks(144, 568))
    work = spark.createDataFrame([("a", png, ""), ("b", png, "painted"), ("c", png, ""), ("d", b"no", "")], "key string, png binary, style string")

    def ask(key, shown):
        assert len(shown) == 3
        return {"a": "MEDIUM: a 3D picture\n", "b": " MEDIUM: 3D", "c": " \n"}[key]

    got = {r.key: (r.caption, r.style, r.error) for r in batch.caption_rooms(work, ask).collect()}
    assert got == {"a": ("MEDIUM: a 3D picture", "rendered", None), "b": ("MEDIUM: 3D", "painted", None), "c": (None, None, "the answer says nothing"), "d": (None, None, "not a PNG")}


def test_reviewable(spark):
    items = spark.createDataFrame([(k, k == "skip", k == "gone") for k in ("open", "old", "done", "rejected", "failed", "gone", "skip", "new")], "key string, skip boolean, output_missing boolean")
    log = [("open", 1, True, True), ("old", 1, True, True), ("old", 2, True, True), ("done", 1, True, True), ("rejected", 1, True, True), ("rejected", 2, True, False), ("failed", 1, True, True), ("failed", 2, False, False), ("gone", 1, True, True), ("skip", 1, True, True)]
    a = spark.createDataFrame([(*r, "w", None, None) for r in log], "key string, n int, record boolean, promoted boolean, workflow string, sha string, input_sha string")
    reviews = spark.createDataFrame([("old", 1, True, [], "review"), ("done", 1, False, ["x"], "review")], "key string, attempt int, accepted boolean, issues array<string>, source string")
    pick = lambda force: sorted(map(tuple, attempts.reviewable(items, a, reviews, force).collect()))
    assert pick(False) == [("old", 2), ("open", 1)] and pick(True) == [("done", 1), ("old", 2), ("open", 1)]


def test_room_reviews(spark):
    source = blocks(144, 320)
    png, render = raster.png_encode(source), raster.png_encode(raster.nearest(source))
    rows = [("a", png, render, "insert", "painted", "TEXT: STOP"), ("b", png, render, "scene", "rendered", "TEXT: STOP"), ("c", png, render, "scene", None, None)]

    def ask(key, question, shown):
        assert len(shown) == 2 and question.startswith("Judge it. " + ("Gloss." if key == "b" else "Brush."))
        assert ("Lettering: STOP." in question) == (key == "a") and "Windows: 1." in question
        if key == "c":
            raise RuntimeError("down")
        return {"a": '{"accepted": true, "issues": []}', "b": '{"accepted": true, "issues": ["x"]}'}[key]

    work = spark.createDataFrame(rows, "key string, source binary, render binary, kind string, style string, caption string")
    got = {r.key: (r.accepted, r.issues, r.error) for r in batch.review_rooms(work, ask, "Judge it. {style_rule}", {"painted": "Brush.", "rendered": "Gloss."}).collect()}
    assert got == {"a": (True, [], None), "b": (None, None, "no valid verdict"), "c": (None, None, "down")}


def test_failed_rooms_are_swept(spark, tmp_path):
    for name in ("room_001_a1-w1_00001_.png", "room_001_a2-seam_00012_.png", "room_0011_a1-w1_00001_.png", "room_001_a1-w1_1_.png"):
        (tmp_path / name).write_bytes(b"x")
    folder = f"file://{tmp_path}"

    def paint(key, seed, *inputs):
        raise RuntimeError("no memory")

    work = spark.createDataFrame([("room_001", 1, raster.png_encode(blocks(144, 320)))], "key string, n int, png binary")
    (r,) = batch.render_rooms(work, paint, sweep=lambda key: services.sweep(folder, key)).collect()
    assert r.error == "no memory" and sorted(p.name for p in tmp_path.iterdir()) == ["room_0011_a1-w1_00001_.png", "room_001_a1-w1_1_.png"]
    assert services.sweep(folder, "room_001") == 0 == services.sweep(f"{folder}/none", "room_001")


def test_services(tmp_path):
    graph = {"prompt": {"1": {"inputs": {"seed": 0, "image": ""}}}}
    (tmp_path / "t.json").write_text(json.dumps(graph))
    (tmp_path / "bad.json").write_text("{}")
    template = services.load_graph(f"file://{tmp_path}/t.json", {("1", "seed"): 7})
    assert template["1"]["inputs"]["seed"] == 7
    for name in ("bad.json", "none.json"):
        with pytest.raises(ValueError):
            services.load_graph(f"file://{tmp_path}/{name}")
    image = blocks(8, 8)
    seen = services.render_window(f"file://{tmp_path}", "room_001_a1-w1", {"guide": image}, template, {"guide": ("1", "image")}, lambda g: g["1"]["inputs"])
    assert seen == {"seed": 7, "image": "room_001_a1-w1-guide.png"} and np.array_equal(raster.png_decode((tmp_path / seen["image"]).read_bytes()), image)
    down = lambda *a: (_ for _ in ()).throw(OSError("refused"))
    asked = []
    assert services.is_up(lambda: {}) and not services.is_up(down) and not services.free_models(down) and services.free_models(asked.append)
    assert asked == [{"unload_models": True, "free_memory": True}]
    assert services.setting("X", 0.5, services.share, {}) == services.setting("X", 0.5, services.share, {"X": ""}) == 0.5 and services.setting("X", 0, services.share, {"X": "0.25"}) == 0.25
    for check, wrong in ((services.share, "1.5"), (services.share, "nan"), (services.one_of("a", "b"), "c")):
        with pytest.raises(ValueError, match="^X="):
            services.setting("X", None, check, {"X": wrong})
    assert services.run_decoder([sys.executable, "-c", "import sys; print(*sys.argv[1:])"], "--frames", "f.san") == b"--frames f.san\n"
    with pytest.raises(RuntimeError, match="ended with 3: bad"):
        services.run_decoder([sys.executable, "-c", "import sys; sys.stderr.write('bad'); sys.exit(3)"], "m", "p")
    assert services.disk_free(f"{tmp_path}/not/there") > 0 and extract.game_root("/g/", "data/") == "/g/data"


def test_plan_lines_times_and_negatives(spark):
    line = lambda rows: spark.createDataFrame(rows, "key string, line string")
    assert [tuple(r) for r in attempts.plan_listing(line([("b", "B"), ("c", "C")]), line([("a", "A")])).orderBy("place").collect()] == [(0, "b", "B"), (1, "c", "C"), (2, "a", "A")]
    w = text.Wording(*"abcdefg", painted_negative="photo", rendered_negative="brush")
    (r,) = spark.sql("SELECT timestamp'2001-02-03 04:05:06.7' AS t").select(text.timestamp_text(F.col("t")).alias("t"), text.negative(F.lit("rendered"), w).alias("a"), text.negative(F.lit("painted"), w).alias("b")).collect()
    assert tuple(r) == ("2001-02-03T04:05:06Z", "brush", "photo")


def test_rooms_are_read_one_by_one(spark, tmp_path):
    pixels = bytes([0, 3, 3, 7, 9, 0, 1, 1])
    rooms = [(*sample_room(5)[:2], costume(1, pixels, 4, 2) + costume(5, pixels, 4, 2)), sample_room(6, bad=True), (7, b"", costume(16, pixels, 4, 2) + costume(9, pixels, 4, 2))]
    (tmp_path / "A.LA1").write_bytes(archive(rooms))
    (tmp_path / "B.LA1").write_bytes(b"junk")
    (tmp_path / "C.LA1").write_bytes(archive(rooms)[:-20])
    names = [c.split()[0] for c in container.BITMAP.split(", ") if not c.startswith("family")]
    key = lambda df: sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    whole, by_room = container.scan(spark, str(tmp_path), "archive", "*.LA1"), container.scan_rooms(spark, str(tmp_path))
    assert key(whole) == key(by_room) and {r.costume for r in by_room.where("family = 'cel'").collect()} == {1, 2, 3, 4}


def test_usage_errors_are_status_2(spark, tmp_path):
    src, out = f"file://{tmp_path}/src", f"file://{tmp_path}/out"
    (tmp_path / "src").mkdir()
    result = extract.extract_checked(spark, src, out, "2026-01-01T00:00:00Z", only="la1,x", required=["A.LA1"], least_free=1 << 60)
    assert result.status == 2 and len(result.errors) == 3 and not (tmp_path / "out").exists()


def test_record_streams_are_compared(spark):
    def stream(pictures, errors=()):
        out = b""
        for w, h, hole, colour, index in pictures:
            out += b"LA1B" + w.to_bytes(2, "little") + h.to_bytes(2, "little") + bytes([hole]) + bytes([colour]) * 768 + bytes(index)
        return out + b"".join(b"LA1E" + at.to_bytes(4, "little") + reason for at, reason in errors)

    a = stream([(2, 1, 0, 1, [1, 2]), (1, 1, 0, 1, [1]), (1, 1, 0, 1, [1]), (1, 1, 1, 1, [1]), (1, 2, 0, 1, [1, 1])], [(5, b"x"), (9, b"y")])
    b = stream([(2, 1, 0, 1, [1, 3]), (1, 1, 0, 2, [1]), (1, 1, 0, 1, [1]), (1, 1, 0, 1, [1]), (2, 1, 0, 1, [1, 1]), (1, 1, 0, 1, [7])], [(5, b"z"), (8, b"y")])
    decode = lambda s: {"s": a, "t": a}[s]
    files = spark.createDataFrame([("s",), ("t",), ("u",)], "source string")
    streams = records.decoded(files, decode)
    assert {r.source: r.error for r in streams.collect()} == {"s": None, "t": None, "u": "'u'"}
    ours = records.scan(streams.where("error IS NULL"), "bitmaps")
    theirs = records.scan(spark.createDataFrame([("s", bytearray(b)), ("t", bytearray(a))], "source string, content binary"), "bitmaps")
    got = sorted((r.source, r.type, r.place, r.difference) for r in records.differences(ours, theirs).collect())
    assert got == [("s", "bitmap", 0, "index"), ("s", "bitmap", 1, "palette"), ("s", "bitmap", 3, "transparent"), ("s", "bitmap", 4, "size"), ("s", "bitmap", 5, "missing"), ("s", "error", 1, "offset")]


def test_displacements_of_a_format(tmp_path):
    lines = [f"{x} {-x % 7}" for x in range(510)]
    (tmp_path / "d.txt").write_text("\n".join(lines) + "\n")
    assert frames.read_displacements(f"file://{tmp_path}/d.txt")[:2] == [(0, 0), (1, 6)]
    (tmp_path / "d.txt").write_text("1 2\n")
    for name in ("d.txt", "none.txt"):
        with pytest.raises(ValueError):
            frames.read_displacements(f"file://{tmp_path}/{name}")
