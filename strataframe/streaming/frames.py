"""Frames as grouped folds and as streams: the state of an animation is carried from frame to frame."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.sources.frames import FrameState, ring_displacements


def folded(frames: DataFrame, displacements: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """(source, frame, index, palette, error) of frame payloads (source, frame, payload), one source at a time in order.

    A source is one group, as each of its frames needs the one before; sources are the parallelism.
    """

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        state = FrameState(key[0], displacements or ring_displacements())
        return _fed(state, frame.sort_values("frame"))

    return frames.groupBy("source").applyInPandas(run, "source string, frame int, index binary, palette binary, error string")


def _fed(state: FrameState, frame: pd.DataFrame) -> pd.DataFrame:
    out = []
    for n, payload in zip(frame["frame"], frame["payload"], strict=True):
        try:
            out.append((state.source, n, *state.feed(bytes(payload)), None))
        except Exception as e:
            out.append((state.source, n, None, None, str(e) or type(e).__name__))
    return pd.DataFrame(out, columns=["source", "frame", "index", "palette", "error"])


def streamed(frames: DataFrame, displacements: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """folded() for a stream: each source's state is kept between batches; frames of a batch are taken in order."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = pickle.loads(state.get[0]) if state.exists else FrameState(key[0], displacements or ring_displacements())
        yield _fed(kept, pd.concat(list(batches)).sort_values("frame"))
        state.update((pickle.dumps(kept, protocol=5),))

    return frames.groupBy("source").applyInPandasWithState(run, "source string, frame int, index binary, palette binary, error string", "state binary", "append", GroupStateTimeout.NoTimeout)


def palette_levels(deltas: DataFrame, source: str, order: list[str], start: Column) -> DataFrame:
    """deltas (source, order, delta, ...) with level: a colour channel from start on, as deltas in 1/128 add up.

    Levels are clipped to 0 to 255 as shown, not as kept.
    """
    upto = Window.partitionBy(source).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    kept = F.shiftright((start * 128).cast("long") + F.sum("delta").over(upto), 7)
    return deltas.withColumn("level", F.least(F.lit(255), F.greatest(F.lit(0), kept)).cast("long"))
