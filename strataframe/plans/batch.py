"""Batches: rooms rendered by an injected painter, reviews by an injected critic, a row of outcome for each item.

Services are callables, so the engine runs without any; what one item raises is its row's error and costs no other.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.functions import raster, text
from strataframe.operators.attempts import FIRST_SEED
from strataframe.operators.manifest import batches
from strataframe.plans import pictures, rooms

OUTCOME = "key string, n int, seed int, promoted boolean, output_sha256 string, png binary, geometry string, error string"
REVIEW = "key string, accepted boolean, issues array<string>, error string"


def render_rooms(work: DataFrame, paint: Callable, method: str = "palette-smooth", strength: float = 0.5, sweep: Callable[[str], object] = lambda key: None) -> DataFrame:
    """Outcomes of the work (key, n, png): attempt n of each room, painted window by window in its own order.

    paint(key, seed, number, crop, composite, mask) returns the painted window. Windows of a room see those before, so
    a room is one call; rooms are the parallelism. The image is promoted if the gate passes. sweep(key) clears away what
    a room that failed, or was given up by hand, may have left.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([one(k, int(n), bytes(png)) for k, n, png in zip(frame["key"], frame["n"], frame["png"], strict=True)], columns=[c.split()[0] for c in OUTCOME.split(", ")])

    def one(key: str, n: int, png: bytes) -> tuple:
        seed = FIRST_SEED + n - 1
        try:
            final, gate = rooms.render_room(raster.png_decode(png), lambda *inputs: paint(key, seed, *inputs), method, strength)
            out = raster.png_encode(final)
            return key, n, seed, not gate.issues, hashlib.sha256(out).hexdigest(), out, json.dumps(gate.as_row()), None
        except Exception as e:
            sweep(key)
            return key, n, seed, False, None, None, None, str(e) or type(e).__name__
        except KeyboardInterrupt:
            sweep(key)
            raise

    return work.select("key", "n", "png").mapInPandas(run, OUTCOME)


def review_batches(objects: DataFrame, ask: Callable, size: int = 8) -> DataFrame:
    """Verdicts on objects (room, key), asked for in batches of a room's objects: ask(room, keys) returns the answer text.

    Objects that the answer leaves out or judges invalidly have a row with an error; so have all of a call that failed.
    """
    asked = batches(objects, "room", "key", size)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for room, keys in zip(frame["room"], frame["keys"], strict=True):
                try:
                    rows.append((keys, ask(room, keys.split(",")), None))
                except Exception as e:
                    rows.append((keys, None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["keys", "answer", "error"])

    answers = asked.select("room", "keys").mapInPandas(run, "keys string, answer string, error string")
    each = answers.select(F.split("keys", ",").alias("all"), "answer", "error").withColumn("found", text.object_verdicts(F.col("answer"), F.col("all")))
    one = each.select(F.explode("all").alias("key"), "found", "error")
    verdict = F.element_at("found", F.col("key"))
    return one.select("key", verdict["accepted"].alias("accepted"), verdict["issues"].alias("issues"), F.coalesce("error", F.when(verdict.isNull(), F.lit("no valid verdict"))).alias("error"))


def caption_rooms(work: DataFrame, ask: Callable) -> DataFrame:
    """(key, caption, style, error) of the work (key, png, style): ask(key, pictures) returns the text.

    A style that is given stays, else the caption tells it. A failing call and an answer that says nothing are errors.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(k, *one(k, bytes(png)), style) for k, png, style in zip(frame["key"], frame["png"], frame["style"], strict=True)], columns=["key", "caption", "error", "given"])

    def one(key: str, png: bytes) -> tuple[str | None, str | None]:
        try:
            image = raster.png_decode(png)
            said = ask(key, pictures.caption_pictures(image, rooms.plan_room(image)))
            return (said.strip(), None) if isinstance(said, str) and said.strip() else (None, "the answer says nothing")
        except Exception as e:
            return None, str(e) or type(e).__name__

    found = work.select("key", "png", "style").mapInPandas(run, "key string, caption string, error string, given string")
    told = F.when(F.col("caption").isNotNull(), F.coalesce(F.nullif("given", F.lit("")), text.style(F.col("caption"))))
    return found.select("key", "caption", told.alias("style"), "error")


def review_rooms(work: DataFrame, ask: Callable, question: str, rules: dict[str, str]) -> DataFrame:
    """(key, accepted, issues, error) of the work (key, source, render, kind, style, caption), source and render as PNG.

    ask(key, question, pictures) is shown each window of the guide beside the render's, and the render as a whole. A
    failing call and an answer without a valid verdict are errors.
    """
    shape = "key string, source binary, render binary, kind string, style string, caption string"

    def planned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(windows=[len(rooms.plan_room(raster.png_decode(bytes(p))).windows) for p in frame["source"]])

    def asked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(k, *one(k, q, bytes(a), bytes(b))) for k, q, a, b in zip(frame["key"], frame["question"], frame["source"], frame["render"], strict=True)], columns=["key", "answer", "error"])

    def one(key: str, said: str, source: bytes, render: bytes) -> tuple[str | None, str | None]:
        try:
            image = raster.png_decode(source)
            return ask(key, said, pictures.review_pictures(raster.guide(image)[1], raster.png_decode(render), rooms.plan_room(image))), None
        except Exception as e:
            return None, str(e) or type(e).__name__

    counted = work.select(*[c.split()[0] for c in shape.split(", ")]).mapInPandas(planned, shape + ", windows int")
    said = text.review_question(question, rules, F.col("windows"), F.col("kind"), F.col("style"), F.col("caption"))
    answers = counted.select("key", said.alias("question"), "source", "render").mapInPandas(asked, "key string, answer string, error string")
    verdict = text.verdict(F.col("answer"))
    return answers.select("key", verdict["accepted"].alias("accepted"), verdict["issues"].alias("issues"), F.coalesce("error", F.when(verdict.isNull(), F.lit("no valid verdict"))).alias("error"))
