import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.functions import raster
from strataframe.plans import batch, extract
from strataframe.sources import container, encoders, sinks, tables
from tests.test_codecs import animation, fade
from tests.test_raster import blocks
from tests.test_sources import archive, costume, font, sample_room


def tree(root):
    (root / "video").mkdir(parents=True)
    (root / "A.LA1").write_bytes(archive([(sample_room(5)[0], sample_room(5)[1], costume(1, bytes([0, 3, 3, 7, 9, 0, 1, 1]), 4, 2)), sample_room(6, bad=True)]))
    (root / "video" / "Intro.SAN").write_bytes(animation(fade(0, 128), fade(256)))
    (root / "Font.NUT").write_bytes(font((1, 4, 1, encoders.run_length_rows(b"\x01\x02\x00\x04", 4)), (9, 1, 1, b"")))
    return root


def test_extract(spark, tmp_path):
    src, out = tree(tmp_path / "src"), tmp_path / "out"
    result = extract.extract(spark, f"file://{src}", f"file://{out}", "2026-01-01T00:00:00Z")
    doc = json.loads((out / "manifest.json").read_text())
    assert result.status == 1 and doc["counts"] == result.counts == {"san_frames": 2, "nut_images": 1, "la1_bitmaps": 4, "errors": 4}
    ids = [a["id"] for a in doc["assets"]]
    assert ids == ["akos:costume001_000", "la1:obj063_01", "la1:obj063_01", "la1:room005", "nut:font:00000", "san:intro:00000", "san:intro:00001"]
    by_id = {a["id"]: a for a in doc["assets"]}
    assert by_id["la1:obj063_01"]["x"] == -16 and "x" not in by_id["la1:room005"] and by_id["la1:room005"]["frame"] is None
    assert all((out / a["path"]).is_file() and (out / "palettes" / f"{a['palette']}.json").is_file() for a in doc["assets"])
    glyph = raster.png_decode((out / by_id["nut:font:00000"]["path"]).read_bytes())
    assert glyph[0, :, 3].tolist() == [255, 255, 0, 255] and by_id["nut:font:00000"]["has_alpha"]
    assert sorted(e["reason"] for e in json.loads((out / "_errors.json").read_text())) == ["unknown NUT codec 9", "unknown OBIM image container", "unknown OBIM image container", "unsupported SMAP codec"]
    again = extract.extract(spark, f"file://{src}", f"file://{out}", "2026-01-01T00:00:00Z", only="san")
    assert again.status == 0 and not (out / "_errors.json").exists() and again.counts["san_frames"] == 2
    with pytest.raises(ValueError, match="unknown kind"):
        extract.wanted_kinds("la1, x")
    assert extract.wanted_kinds(" NUT,san") == ["san", "nut"] and extract.missing_files(spark, f"file://{src}", ["A.LA1", "B.LA1"]) == ["B.LA1"]


def manifest_file(path, assets, version="0.2.0", tool="strataframe"):
    path.write_text(json.dumps({"tool": tool, "tool_version": version, "counts": {}, "assets": assets}))
    return f"file://{path}"


ROOM = {"id": "la1:room001", "kind": "la1_bitmap", "source": "A", "frame": None, "name": "room001", "width": 320, "height": 144, "has_alpha": False, "palette": "p", "path": "la1/room001.png", "room": 1}
OBJ = ROOM | {"id": "la1:obj010_0A", "name": "obj010_0A", "path": "la1/o.png", "x": 4, "y": -2}


def test_manifest_is_checked(spark, tmp_path):
    uri = manifest_file(tmp_path / "m.json", [ROOM, OBJ, {"id": "akos:c", "kind": "la1_bitmap", "name": "c"}, {"id": "san:x", "kind": "san_frame"}])
    rooms_, objects = tables.rooms_and_objects(tables.load_manifest(spark, uri, "strataframe"))
    assert [(r.key, r.width) for r in rooms_.collect()] == [("room_001", 320)] and [(r.key, r.x, r.y) for r in objects.collect()] == [("obj010_0A", 4, -2)]
    for k, (bad, said) in enumerate({"unexpected": ROOM | {"name": "door"}, "another room": ROOM | {"room": 2}, "multiple of 8": ROOM | {"width": 321}, "relative path": ROOM | {"path": "../x"}, "positive": ROOM | {"height": 0}, '"x" and "y"': OBJ | {"x": None}, "has_alpha": ROOM | {"has_alpha": None}}.items()):
        uri = manifest_file(tmp_path / f"bad{k}.json", [said])
        with pytest.raises(Exception, match=bad):
            [df.collect() for df in tables.rooms_and_objects(tables.load_manifest(spark, uri, "strataframe"))]
    doubled = tables.load_manifest(spark, manifest_file(tmp_path / "d.json", [ROOM, ROOM, OBJ, OBJ]), "strataframe")
    for df, said in zip(tables.rooms_and_objects(doubled), ("duplicate room 1", "duplicate object obj010_0A"), strict=True):
        with pytest.raises(Exception, match=said):
            df.collect()
    for text, said in ((manifest_file(tmp_path / "o.json", [], "0.1.9"), "tool_version"), (manifest_file(tmp_path / "t.json", [], tool="x"), "not a strataframe"), (manifest_file(tmp_path / "v.json", [], "new"), "tool_version")):
        with pytest.raises(tables.TableError, match=said):
            tables.load_manifest(spark, text, "strataframe")
    (tmp_path / "j.json").write_text("{oops")
    with pytest.raises(tables.TableError, match="JSON"):
        tables.load_manifest(spark, f"file://{tmp_path}/j.json", "strataframe")


def test_yaml_tables(spark, tmp_path):
    f = tmp_path / "rooms.yaml"
    f.write_text("room_001: {kind: scene, caption: }\nroom_002:\n  kind: insert\n  style: rendered\n  skip_objects: [obj010_0A]\n  caption: |\n    two  \n    lines\n\n")
    got = tables.load_rooms(spark, f"file://{f}")
    assert {r.key: (r.kind, r.caption.strip(), r.style, r.skip_objects) for r in got.collect()} == {"room_001": ("scene", "", "", []), "room_002": ("insert", "two  \nlines", "rendered", ["obj010_0A"])}
    saved = tables.dump(got, tables.ROOM_FIELDS, ("style", "skip_objects"))
    f.write_text(saved)
    assert "skip_objects" not in saved.split("room_002")[0] and tables.load_rooms(spark, f"file://{f}").count() == 2
    for text, said in {"room_1: {kind: scene}": "not a key", "room_001: {kind: door}": "one of scene", "room_001: {kind: scene, colour: red}": "unknown field", "room_001: {kind: scene, caption: 3}": "a string", "room_001: {kind: scene, skip_objects: [x]}": "object keys", "- a": "mapping", "a: [": "YAML", "room_001: 5": "mapping"}.items():
        f.write_text(text)
        with pytest.raises(tables.TableError, match=said):
            tables.load_rooms(spark, f"file://{f}")
    f.write_text("room_001: {attempt: 1, accepted: true, issues: []}\nobj010_02: {attempt: 0, accepted: false, issues: [halo], source: geometry}\n")
    assert sorted(map(tuple, tables.load_reviews(spark, f"file://{f}").collect())) == [("obj010_02", 0, False, ["halo"], "geometry"), ("room_001", 1, True, [], "review")]
    for text, said in {"{attempt: -1, accepted: true, issues: []}": "non-negative", "{attempt: true, accepted: true, issues: []}": "non-negative", "{attempt: 1, accepted: 1, issues: []}": "true or false", "{attempt: 1, accepted: false, issues: []}": "contradicts", "{attempt: 1, accepted: false, issues: [' ']}": "non-empty", "{attempt: 1, accepted: true, issues: [], source: me}": "one of review"}.items():
        f.write_text(f"room_001: {text}")
        with pytest.raises(tables.TableError, match=said):
            tables.load_reviews(spark, f"file://{f}")
    assert tables.load_reviews(spark, f"file://{tmp_path}/none.yaml", optional=True).count() == 0
    with pytest.raises(tables.TableError, match="not found"):
        tables.load_rooms(spark, f"file://{tmp_path}/none.yaml")


def test_attempt_log(spark, tmp_path):
    a = tmp_path / "room_001"
    (a / "attempt-3.tiles").mkdir(parents=True)
    (a / "attempt-1.json").write_text('{"promoted": true, "output_sha256": "s", "workflow": "w"}')
    (a / "attempt-1.png").write_bytes(b"x")
    (a / "attempt-2.json").write_text("[1]")
    (a / "attempt-3.tiles" / "t.png").write_bytes(b"x")
    (a / "attempt-4.json").write_text("{broken")
    (a / "other.txt").write_text("x")
    got = sorted(map(tuple, tables.attempt_log(spark, f"file://{tmp_path}").collect()))
    assert [r[:4] for r in got] == [("room_001", 1, True, True), ("room_001", 2, False, False), ("room_001", 3, False, False), ("room_001", 4, False, False)]


def test_batch_with_a_fake_painter(spark):
    def paint(key, seed, number, crop, composite, mask):
        if key == "room_003":
            raise RuntimeError("the painter is out")
        assert seed == 43
        return np.roll(composite, 12, 1) if key == "room_002" else composite

    rows = [(f"room_{i:03d}", 2, raster.png_encode(blocks(144, 320, seed=i))) for i in (1, 2, 3)] + [("room_004", 2, raster.png_encode(np.zeros((64, 64, 3), np.uint8))), ("room_005", 2, b"junk")]
    got = {r.key: r for r in batch.render_rooms(spark.createDataFrame(rows, "key string, n int, png binary"), paint).collect()}
    assert got["room_001"].promoted and raster.png_decode(bytes(got["room_001"].png)).shape == (576, 1280, 3)
    assert not got["room_002"].promoted and "shifted" in got["room_002"].geometry
    assert [got[f"room_{i:03d}"].error for i in (3, 5)] == ["the painter is out", "not a PNG"] and "flat" in got["room_004"].error


def test_review_batches(spark):
    def ask(room, keys):
        assert len(keys) <= 8
        if room == 2:
            raise RuntimeError("no answer")
        return "```json\n" + json.dumps({"objects": {k: {"accepted": k != "o03", "issues": ["halo"] if k == "o03" else []} for k in keys if k != "o01"} | {"else": {"accepted": True, "issues": []}}}) + "\n```"

    rows = [(1, f"o{i:02d}") for i in range(19)] + [(2, "p")]
    got = {r.key: r for r in batch.review_batches(spark.createDataFrame(rows, "room int, key string"), ask).collect()}
    assert len(got) == 20 and got["o00"].accepted and got["o03"].issues == ["halo"] and (got["o01"].error, got["p"].error) == ("no valid verdict", "no answer")


def test_sinks(tmp_path):
    uri = f"file://{tmp_path}/deep/a.txt"
    sinks.write_atomic(uri, b"1")
    sinks.write_atomic(uri, b"2")
    assert (tmp_path / "deep" / "a.txt").read_bytes() == b"2" and [p.name for p in (tmp_path / "deep").iterdir()] == ["a.txt"]
    sinks.write_errors([{"a": 1}], f"file://{tmp_path}/e.json")
    sinks.write_errors([], f"file://{tmp_path}/e.json")
    assert not (tmp_path / "e.json").exists()
    sinks.write_nearest(blocks(4, 8), f"file://{tmp_path}/n.png")
    assert raster.png_decode((tmp_path / "n.png").read_bytes()).shape == (16, 32, 3)
