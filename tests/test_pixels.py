"""Raster operators against plain loops, on rasters with and without holes."""

import random

import pytest

from strataframe.operators import pixels


def images(holes, seed=3):
    rng = random.Random(seed)
    out = {}
    for img in range(4):
        for y in range(rng.randrange(1, 7)):
            for x in range(rng.randrange(1, 9)):
                if rng.random() >= holes:
                    out[img, y, x] = rng.randrange(256)
    return out


def frame(spark, px):
    return spark.createDataFrame([(*k, v) for k, v in px.items()], "img int, y int, x int, v int").repartition(3)


def line(px, i, y, x):
    """The values to the left, at and to the right of a pixel, which stands for missing ones."""
    v = px[i, y, x]
    return px.get((i, y, x - 1), v), v, px.get((i, y, x + 1), v)


def nine(px, i, y, x):
    """Three lines around a pixel, whose own stands for a missing one."""
    own = line(px, i, y, x)
    return [line(px, i, b, x) if (i, b, x) in px else own for b in (y - 1, y, y + 1)]


@pytest.mark.parametrize("holes", [0.0, 0.3, 0.8])
def test_sobel(spark, holes):
    px = images(holes)
    for replicate in (True, False):
        got = {(r.img, r.y, r.x): (r.gx, r.gy, r.gg) for r in pixels.sobel(frame(spark, px), replicate=replicate).collect()}
        want = {}
        for i, y, x in px:
            (a, b, c), (d, _, e), (f, g, h) = nine(px, i, y, x) if replicate else [[px.get((i, y + j, x + k), 0) for k in (-1, 0, 1)] for j in (-1, 0, 1)]
            gx, gy = c + 2 * e + h - a - 2 * d - f, f + 2 * g + h - a - 2 * b - c
            want[i, y, x] = (gx, gy, gx * gx + gy * gy)
        assert got == want


@pytest.mark.parametrize("replicate", [True, False])
def test_sobel_of_large_values(spark, replicate):
    px = images(0.3)
    sobel = lambda px: {(r.img, r.y, r.x): (r.gx, r.gy, r.gg) for r in pixels.sobel(frame(spark, px), replicate=replicate).collect()}
    large = sobel({k: v * 1_000_000 for k, v in px.items()})
    assert large == {k: (gx * 10**6, gy * 10**6, gg * 10**12) for k, (gx, gy, gg) in sobel(px).items()}
    assert max(gg for _, _, gg in large.values()) > 2**31


def test_sobel_of_sums_beyond_int(spark):
    px = {k: 2**31 - 1 - v for k, v in images(0.0).items()}
    steep = {k: 255 - v for k, v in images(0.0).items()}
    got, want = ({(r.img, r.y, r.x): (r.gx, r.gy, r.gg) for r in pixels.sobel(frame(spark, p)).collect()} for p in (px, steep))
    assert got == want


@pytest.mark.parametrize("holes", [0.0, 0.3, 0.8])
def test_grown_smoothed_and_steps(spark, holes):
    px = images(holes, 5)
    df = frame(spark, px)
    got = {(r.img, r.y, r.x): r.near for r in pixels.grown(df.withColumn("near", df.v > 200), "near").collect()}
    assert got == {(i, y, x): any(px.get((i, y + j, x + k), 0) > 200 for j in (-1, 0, 1) for k in (-1, 0, 1)) for i, y, x in px}
    got = {(r.img, r.y, r.x): (r.total, r.n) for r in pixels.smoothed(df, 60).collect()}
    near = {k: [n for row in nine(px, *k) for n in row if abs(n - v) <= 60] for k, v in px.items()}
    assert got == {k: (sum(ns), len(ns)) for k, ns in near.items()}
    got = {(r.img, r.x): (r.step_total, r.n) for r in pixels.column_steps(df).collect()}
    steps = {}
    for (i, y, x), v in px.items():
        if (i, y, x - 1) in px:
            steps.setdefault((i, x), []).append(abs(v - px[i, y, x - 1]))
    assert got == {k: (sum(s), len(s)) for k, s in steps.items()}


@pytest.mark.parametrize("holes", [0.0, 0.1])
def test_wrap_period(spark, holes):
    rng = random.Random(7)
    px = {}
    for img, period in enumerate((6, 9, 40)):
        tile = [[rng.randrange(9) for _ in range(period)] for _ in range(4)]
        px |= {(img, y, x): tile[y][x % period] for y in range(4) for x in range(40) if rng.random() >= holes}
    px[0, 1, 30] = 77  # one pixel of a repeat differs
    for match in (1.0, 0.9):
        got = {r.img: r.period for r in pixels.wrap_period(frame(spark, px), 40, least=4, span=8, match=match).collect()}
        want = {}
        for img in range(3):
            for p in range(4, 33):
                pairs = [px[img, y, x] == px[img, y, x - p] for y in range(4) for x in range(p, 40) if (img, y, x) in px and (img, y, x - p) in px]
                if pairs and sum(pairs) / len(pairs) >= match - 1e-12:
                    want[img] = p
                    break
        assert got == want
