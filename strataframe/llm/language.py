"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by SGD in numpy.

A text's subwords are its character n-grams within words, word ends marked. The mean of their hashed embeddings goes
through one linear layer; a temperature fitted on rows kept out of training makes its best probability a score, and a
threshold on that score, from the same rows, is what rejects. Training sees a bounded sample of labelled rows on the
driver; prediction reads every whole text once, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import small_batches

BUCKETS, DIM, NGRAMS = 1 << 16, 16, (1, 2, 3, 4)
SAMPLE_ROWS = 4_000  # labelled rows that training takes at most, on average, shared evenly among languages
SAMPLE_CHARS = 20_000  # of a longer text training takes a part of this length, from a place that its hash gives
KEPT = 8_000_000  # shares of whole texts' subwords that training keeps from one round to the next
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def subwords(text: str) -> np.ndarray:
    """Buckets of all subwords of a text, repeats included: n-grams of lower-cased letters, runs of others as word ends."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of other characters ends the word
    marked = np.concatenate([[0], np.where(letter, code, 0)[keep], [0]]).astype(np.uint64)
    if len(marked) > 1 and marked[-2] == 0:
        marked = marked[:-1]
    inner = marked > 0
    found = []
    for n in NGRAMS:
        size = len(marked) - n + 1
        if size < 1:
            continue
        h = np.full(size, n, np.uint64)
        ok = inner[:size].copy() if n == 1 else inner[:size] | inner[1 : size + 1]
        for j in range(n):
            h = (h ^ marked[j : j + size]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if 0 < j < n - 1:
                ok &= inner[j : j + size]  # word ends stand first or last
        found.append((h[ok] >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32))
    return np.concatenate(found) if found else np.empty(0, np.int32)


@dataclass
class Model:
    languages: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def hidden(self, text: str) -> np.ndarray | None:
        at = subwords(text)
        if not len(at):
            return None
        return sum(self.embeddings[at[i : i + 100_000]].sum(0, dtype=np.float64) for i in range(0, len(at), 100_000)) / len(at)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, calibrated probability); (UNKNOWN, 0) for texts without letters and without any language learned."""
        if not self.languages or not text or (h := self.hidden(text)) is None:
            return UNKNOWN, 0.0
        p = softmax((self.weights @ h + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _snippet(text: str, rng: np.random.Generator) -> str:
    size = int(rng.integers(10, 300))
    start = int(rng.integers(0, max(1, len(text) - size)))
    return text[start : start + size]


def _shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct subwords of a text and the share of each."""
    at, times = np.unique(subwords(text), return_counts=True)
    return at, (times / max(1, times.sum())).astype(np.float32)


def train(texts: list[str], labels: list[str], epochs: int = 4, rate: float = 1.0, seed: int = 1, miss: float = 0.002) -> Model:
    """Fits on four fifths of the rows, whole texts and random snippets of them; the rest calibrate.

    reject_below is such that of the calibration rows that are predicted right, as whole texts, about the share miss is
    rejected, and never above an even chance.
    """
    rows = [(t, y) for t, y in zip(texts, labels, strict=True) if has_letter(t)]
    languages = sorted({y for _, y in rows})
    rng = np.random.default_rng(seed)
    m = Model(languages, rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32), np.zeros((len(languages), DIM)), np.zeros(len(languages)))
    if len(languages) < 2:
        return m
    place = {y: i for i, y in enumerate(languages)}
    order = rng.permutation(len(rows))
    fit, held = order[: max(1, len(rows) * 4 // 5)], order[len(rows) * 4 // 5 :]
    steps, step = epochs * len(fit) * 3, 0
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    room = KEPT
    for _ in range(epochs):
        for i in rng.permutation(fit):
            text, y = rows[i][0], place[rows[i][1]]
            whole = known.get(i) or _shares(text)
            if i not in known and len(whole[0]) <= room:
                known[i], room = whole, room - len(whole[0])
            for at, share in (whole, _shares(_snippet(text, rng)), _shares(_snippet(text, rng))):
                step += 1
                if not len(at):
                    continue
                h = share @ m.embeddings[at]
                g = softmax(m.weights @ h + m.bias)
                g[y] -= 1
                lr = rate * (1 - step / steps)
                back = (m.weights.T @ g).astype(np.float32)
                m.weights -= lr * np.outer(g, h)
                m.bias -= 0.1 * lr * g
                m.embeddings[at] -= np.float32(lr * 20) * np.outer(share, back)
    _calibrate(m, [rows[i] for i in held], place, rng, miss)
    return m


def _calibrate(m: Model, held: list[tuple[str, str]], place: dict[str, int], rng: np.random.Generator, miss: float) -> None:
    parts = [(p, place[y], whole) for t, y in held for whole, p in ((True, t), (False, _snippet(t, rng)))]
    scored = [(m.weights @ h + m.bias, y, whole) for p, y, whole in parts if (h := m.hidden(p)) is not None]
    if not scored:
        return
    z, y = np.array([s[0] for s in scored]), np.array([s[1] for s in scored])
    whole = np.array([s[2] for s in scored])
    loss = lambda t: -np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean()
    m.temperature = float(min(np.geomspace(0.1, 10, 81), key=loss))
    p = softmax(z / m.temperature)
    right = p.max(1)[(p.argmax(1) == y) & whole]
    if len(right):
        m.reject_below = float(min(0.5, np.quantile(right, miss)))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from labelled rows that are not held out: those of each language whose hash is below its rate.

    About sample_rows rows in all come to the driver, of at most SAMPLE_CHARS characters each: a longer text comes
    with a part of that length, from anywhere in it. The same rows give the same model. Without a labelled row, the
    model knows no language.
    """
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(sample_rows).collect()}
    if not counts:
        return train([], [])
    each = max(1, sample_rows // len(counts))
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20))
    rate = F.lit(0)
    for lang, n in counts.items():
        rate = F.when(F.col("lang") == lang, F.lit(max(1, min(1 << 20, (each << 20) // n)))).otherwise(rate)
    drawn = labelled.where(draw < rate).withColumn("hash", F.xxhash64("id", "text"))
    start = F.pmod("hash", F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS + 1)).cast("int") + 1
    drawn = drawn.select("hash", F.when(F.length("text") <= SAMPLE_CHARS, F.col("text")).otherwise(F.substr("text", start, F.lit(SAMPLE_CHARS))).alias("text"), "lang")
    sample = drawn.orderBy("hash", "text", "lang").limit(2 * sample_rows).collect()
    return train([r.text for r in sample], [r.lang for r in sample])


def _predictor(model, text_col: str, drop: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m: Model = model.value
        for frame in frames:
            found = [m.predict(t if isinstance(t, str) else None) for t in frame[text_col]]
            out = frame.drop(columns=[text_col]) if drop else frame.copy()
            out["lang_pred"], out["score"], out["rejected"] = [x[0] for x in found], [x[1] for x in found], [x[0] == UNKNOWN or x[1] < m.reject_below for x in found]
            yield out

    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(*keep, lang_pred, score, rejected), one row a document, from the whole text and nothing else.

    Null texts and texts without letters get UNKNOWN with score 0 and are rejected; others are rejected if the score
    is below the model's threshold. Without any labelled row all get UNKNOWN. Repeated rows and null ids do no harm.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS * DIM numbers, whatever the data
    drop = text_col not in keep
    kept = docs.select(*keep, *[text_col] * drop)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if not drop or f.name != text_col)
    return kept.mapInPandas(_predictor(sent, text_col, drop), schema + ", lang_pred string, score double, rejected boolean")
