"""Pictures that a critic or a caption writer is shown: enlarged rooms, windows, pairs, and how they are sent."""

from __future__ import annotations

import base64

import numpy as np

from strataframe.functions import raster
from strataframe.plans.rooms import RoomPlan

#: Fixed value: the longer side of a picture as it is sent.
LONG_SIDE = 1280


def side_by_side(left: np.ndarray, right: np.ndarray, gap: int = 16) -> np.ndarray:
    """Two pictures on black, with a gap between."""
    out = np.zeros((max(len(left), len(right)), left.shape[1] + gap + right.shape[1], 3), np.uint8)
    out[: len(left), : left.shape[1]] = left[..., :3]
    out[: len(right), left.shape[1] + gap :] = right[..., :3]
    return out


def fitted(image: np.ndarray, side: int = LONG_SIDE) -> np.ndarray:
    """The picture with its longer side as given: nearest neighbours when that enlarges it, smoothly when it shrinks."""
    h, w = image.shape[:2]
    ratio = side / max(h, w)
    to_h, to_w = max(1, round(h * ratio)), max(1, round(w * ratio))
    if ratio > 1:
        return image[(np.arange(to_h) * h // to_h)][:, (np.arange(to_w) * w // to_w), :3]
    return raster.lanczos(image[..., :3], to_w, to_h) if ratio < 1 else image[..., :3]


def data_url(image: np.ndarray) -> str:
    return "data:image/png;base64," + base64.b64encode(raster.png_encode(fitted(image))).decode()


def caption_pictures(image: np.ndarray, plan: RoomPlan) -> list[np.ndarray]:
    """The room twice enlarged, then each window four times if there are several."""
    whole = [raster.nearest(image[..., :3], 2)]
    cut = [image[w.y0 : min(w.y1, len(image)), w.x0 : w.x1, :3] for w in plan.windows] if len(plan.windows) > 1 else []
    return whole + [raster.nearest(c) for c in cut]


def review_pictures(guide: np.ndarray, render: np.ndarray, plan: RoomPlan) -> list[np.ndarray]:
    """Each window of the guide beside the same of the render, then the whole render."""
    s = raster.SCALE
    cut = lambda i, w: i[w.y0 * s : min(w.y1 * s, len(render)), w.x0 * s : w.x1 * s]
    return [side_by_side(cut(guide, w), cut(render, w)) for w in plan.windows] + [render[..., :3]]
