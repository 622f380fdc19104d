import random
import struct
import zlib

import numpy as np
import pytest

from strataframe.functions import raster
from strataframe.plans import pictures, rooms, windows


def blocks(h, w, cell=16, seed=1, bands=3):
    rng = np.random.default_rng(seed)
    small = rng.choice(np.array([10, 90, 170, 250], np.uint8), (-(-h // cell), -(-w // cell), 3))
    image = small.repeat(cell, 0).repeat(cell, 1)[:h, :w]
    return np.dstack([image, np.full((h, w), 255, np.uint8)]) if bands == 4 else image.copy()


def test_png_round_trip_and_filters():
    rng = np.random.default_rng(3)
    for bands in (3, 4):
        image = rng.integers(0, 256, (5, 7, bands), dtype=np.uint8)
        data = raster.png_encode(image)
        assert np.array_equal(raster.png_decode(data), image) and raster.png_encode(image) == data
    image = rng.integers(0, 256, (5, 6, 3), dtype=np.uint8)
    raw, zero = b"", np.zeros(3, int)
    for y in range(5):
        raw += bytes([y])
        for x in range(6):
            a = image[y, x - 1].astype(int) if x else zero
            b = image[y - 1, x].astype(int) if y else zero
            c = image[y - 1, x - 1].astype(int) if x and y else zero
            p = a + b - c
            near = np.array([a, b, c])[np.argmin(np.abs(np.array([p - a, p - b, p - c])), axis=0), range(3)]
            raw += ((image[y, x].astype(int) - [zero, a, b, (a + b) // 2, near][y]) % 256).astype(np.uint8).tobytes()
    part = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
    made = b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", 6, 5, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")
    assert np.array_equal(raster.png_decode(made), image)
    with pytest.raises(ValueError):
        raster.png_decode(b"GIF89a")


def test_resampling():
    image = blocks(16, 24)
    assert np.array_equal(raster.box(raster.nearest(image)), image)
    flat = np.full((6, 9, 3), 77, np.uint8)
    assert (raster.lanczos(flat, 36, 24) == 77).all() and (raster.smoothed(flat) == 77).all() and (raster.blurred(flat) == 77).all()
    checker = np.indices((8, 8)).sum(0)[..., None] % 2 * np.full(3, 20, np.uint8) + 100
    assert np.ptp(raster.smoothed(checker.astype(np.uint8))[1:-1, 1:-1]) < 20
    edge = np.repeat(np.where(np.arange(8) < 4, 0, 255)[None, :, None], 8, 0).repeat(3, 2).astype(np.uint8)
    assert np.array_equal(raster.smoothed(edge), edge)
    with pytest.raises(ValueError, match="unknown de-dither"):
        raster.dedithered(edge, "median")


def test_fill_and_alpha():
    image = blocks(12, 12, 4, bands=4)
    image[4:8, 4:8] = 0
    out = raster.filled(image)
    assert np.array_equal(out[:4], image[:4, :, :3]) and out[5, 5].any()
    grown_alpha = raster.with_alpha(raster.nearest(out), image)
    assert raster.alpha_matches(grown_alpha, image) and not raster.alpha_matches(grown_alpha[..., :3], image)
    hidden = np.zeros((2, 2, 4), np.uint8)
    assert (raster.filled(hidden) == 0).all()


def test_colour():
    every = np.array(random.Random(1).sample(range(1 << 24), 4000))
    rgb = np.stack([every >> 16, every >> 8 & 255, every & 255], -1).astype(np.uint8).reshape(40, 100, 3)
    assert np.array_equal(raster.to_rgb(raster.to_lab(rgb)), rgb)
    assert np.allclose(raster.to_lab(np.full((1, 1, 3), 255, np.uint8)), [100, 0, 0], atol=1e-9)
    assert np.array_equal(raster.colour_matched(rgb, rgb), rgb) and np.array_equal(raster.colour_matched(rgb, 255 - rgb, 0), rgb)
    flat, target = np.full((8, 8, 3), 50, np.uint8), blocks(8, 8, 2)
    assert np.ptp(raster.colour_matched(flat, target).reshape(-1, 3), axis=0).max() == 0
    dark = (rgb // 2).astype(np.uint8)
    assert abs(raster.to_lab(raster.colour_matched(dark, rgb)).mean() - raster.to_lab(rgb).mean()) < 1.5


def test_gate_passes_its_own_guide_and_catches_shifts():
    source = blocks(144, 320)
    own = raster.gate(raster.nearest(source), source, [(0, 0, 320, 144)], [640], [200])
    assert not own.issues and own.shift == (0.0, 0.0) and own.edge_agreement == 1.0
    moved = raster.gate(raster.nearest(np.roll(source, 2, 1)), source, [(0, 0, 160, 144), (160, 0, 320, 144)])
    assert moved.shift[0] == pytest.approx(2, abs=0.1) and any("shifted" in i for i in moved.issues) and moved.as_row()["passed"] is False
    assert any("edges" in i for i in raster.gate(np.full((576, 1280, 3), 128, np.uint8), source).issues)
    assert raster.phase_shift(np.zeros((8, 8)), np.zeros((8, 8))) == (0.0, 0.0)
    step = np.full((8, 64, 3), 10, np.uint8)
    assert raster.seam_ratio(step, 32) == 0.0
    step[:, 32:] = 90
    assert raster.seam_ratio(step, 32) == raster.SEAM_CAP


@pytest.mark.parametrize(("start", "end", "size", "spans"), [(0, 320, 320, [(0, 320)]), (64, 240, 320, [(64, 240)]), (0, 568, 320, [(0, 320), (248, 568)]), (0, 840, 320, [(0, 320), (168, 488), (344, 664), (520, 840)]), (0, 400, 240, [(0, 240), (160, 400)]), (0, 472, 240, [(0, 240), (112, 352), (232, 472)]), (0, 784, 240, [(0, 240), (136, 376), (272, 512), (408, 648), (544, 784)])])
def test_axis_goldens(start, end, size, spans):
    assert windows.plan_axis(start, end, size) == spans


def test_axis_rules():
    for end in range(330, 3000, 8):
        spans = windows.plan_axis(0, end, 320)
        assert spans[0][0] == 0 and spans[-1][1] == end and all(b - a == 320 for a, b in spans)
        assert all(a % 8 == 0 for a, _ in spans[:-1]) and all(p[1] - q[0] >= 64 for p, q in zip(spans, spans[1:], strict=False))


@pytest.mark.parametrize(("args", "box"), [((200, 60, 40, 40, 568, 144), (152, 16, 280, 144)), ((40, 24, 48, 32, 320, 144), (0, 0, 128, 128)), ((280, 100, 40, 40, 320, 144), (192, 16, 320, 144)), ((0, 0, 8, 8, 16, 200), (0, 0, 16, 128)), ((100, 200, 40, 30, 352, 230), (56, 104, 184, 232))])
def test_context_goldens(args, box):
    x, y, w, h, rw, rh = args
    (x0, x1), (y0, y1) = rooms.context_span(x, w, rw), rooms.context_span(y, h, rh)
    assert (x0, y0, x1, y1) == box


def test_room_plans():
    assert [w.box for w in rooms.plan_room(blocks(144, 320)).windows] == [(0, 0, 320, 144)]
    two = rooms.plan_room(blocks(144, 568))
    assert two.boundaries == ([1136], []) and len(two.windows) == 2
    grid = rooms.plan_room(blocks(470, 352))
    assert len(grid.windows) == 6 and grid.windows[3].box == (32, 112, 352, 352) and grid.height == 472
    assert grid.windows[3].origin == (176, 176) and grid.boundaries == ([704], [704, 1168])
    framed = blocks(40, 60)
    framed[:3], framed[-2:], framed[:, :2], framed[:, -4:] = 0, 0, 0, 0
    assert rooms.margins(rooms.colour_keys(framed)) == {"left": 2, "right": 4, "top": 3, "bottom": 2}
    with pytest.raises(ValueError, match="flat"):
        rooms.plan_room(np.zeros((200, 16, 3), np.uint8))


def wraparound():
    body = blocks(144, 840, 8)
    return np.concatenate([body, body[:, :224], np.zeros((144, 88, 3), np.uint8)], axis=1)


def test_wraparound():
    plan = rooms.plan_room(wraparound())
    assert (plan.period, plan.content_end - plan.period, plan.margins["right"]) == (840, 224, 88)
    assert plan.boundaries[0] == [320, 976, 1664, 2368, 3040, 3360]


@pytest.mark.parametrize("image", [blocks(144, 568), wraparound(), blocks(250, 330, bands=4)])
def test_render_with_a_painter_that_returns_the_composite(image):
    seen = []

    def paint(number, crop, composite, mask):
        assert crop.shape == composite.shape and mask.shape == crop.shape[:2]
        seen.append((number, int(mask.min())))
        return composite

    final, gate = rooms.render_room(image, paint)
    assert final.shape == (image.shape[0] * 4, image.shape[1] * 4, image.shape[2]) and not gate.issues
    assert seen[0] == (1, 255) and all(low == 0 for _, low in seen[1:])
    with pytest.raises(ValueError, match="expected"):
        rooms.render_room(image, lambda n, c, composite, m: composite[:-4])


def test_objects():
    room = blocks(144, 320)
    same = np.dstack([room[24:56, 40:88], np.full((32, 48), 255, np.uint8)])
    assert rooms.classify(same, room, 40, 24) == "identical"
    other = same.copy()
    other[4:8, 4:8, :3] = 255 - other[4:8, 4:8, :3]
    assert rooms.classify(other, room, 40, 24) == "render" and rooms.changed(other, room, 40, 24).sum() == 16
    inputs = rooms.object_inputs(raster.nearest(room), room, other, 40, 24)
    assert inputs.box == (0, 0, 128, 128) and inputs.changed.sum() == 256 and (inputs.composite[inputs.mask == 0] == inputs.base[inputs.mask == 0]).all()
    assert 0 < ((inputs.mask > 0) & (inputs.mask < 255)).sum() and (inputs.mask[inputs.changed] == 255).all()
    done = rooms.composed(inputs.composite, inputs, 0)
    assert not rooms.object_gate(done, inputs).issues and rooms.cut_out(done, inputs).shape == (128, 192, 3)
    assert any("outside" in i for i in rooms.object_gate(255 - done, inputs).issues)


def test_pictures():
    room = blocks(144, 568)
    plan = rooms.plan_room(room)
    assert [p.shape for p in pictures.caption_pictures(room, plan)] == [(288, 1136, 3), (576, 1280, 3), (576, 1280, 3)]
    render = raster.nearest(room)
    shown = pictures.review_pictures(render, render, plan)
    assert [p.shape for p in shown] == [(576, 2576, 3)] * 2 + [(576, 2272, 3)] and np.array_equal(shown[0][:, :1280], shown[0][:, 1296:])
    assert pictures.fitted(room).shape == pictures.fitted(render).shape == (325, 1280, 3)
    url = pictures.data_url(room)
    assert url.startswith("data:image/png;base64,") and len(url) > 100
