"""The life cycle of items as a stream: each batch of events moves the state of its keys, and only those are reported."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from strataframe.operators.attempts import MAX_ATTEMPTS

STATUS = "key long, status string, latest int, records int"
STATE = "latest int, records int, last_record int, last_promoted boolean, latest_recorded boolean, review int, accepted boolean"


def _fold(state: dict, event) -> None:
    """One event: an attempt (record, promoted) or a review (accepted) of attempt n. A later attempt moves the state on."""
    if event.kind == "review":
        if event.n >= (state["review"] or 0):
            state["review"], state["accepted"] = int(event.n), bool(event.accepted)
        return
    if event.n >= state["latest"]:
        state["latest"], state["latest_recorded"] = int(event.n), bool(event.record)
    if event.record:
        state["records"] += 1
        if event.n >= state["last_record"]:
            state["last_record"], state["last_promoted"] = int(event.n), bool(event.promoted)


def status_of(s: dict, max_attempts: int = MAX_ATTEMPTS) -> str:
    """The state's status, by the rules of operators.attempts.item_status; outputs count as there."""
    current = s["review"] is not None and s["review"] <= s["latest"]

    def rejected(n: int, promoted: bool) -> bool:
        return not promoted or (current and not s["accepted"] and s["review"] >= n)

    if not s["latest"]:
        return "new"
    if s["records"] >= max_attempts and rejected(s["last_record"], s["last_promoted"]):
        return "stuck"
    if not s["latest_recorded"]:
        return "failed"
    return "rejected" if rejected(s["latest"], s["last_promoted"]) else "done"


def status_stream(events: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Updates (key, status, latest, records) from a stream of events (key long, kind, n, record, promoted, accepted).

    kind is attempt or review. Events of a batch are taken by n, attempts before reviews; a key's state is a few
    numbers, however long its log.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    names = [c.split()[0] for c in STATE.split(", ")]

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        s = dict(zip(names, state.get if state.exists else (0, 0, 0, False, False, None, None), strict=True))
        for event in pd.concat(list(batches)).sort_values(["n", "kind"]).itertuples():
            _fold(s, event)
        state.update(tuple(s[n] for n in names))
        yield pd.DataFrame([(key[0], status_of(s, max_attempts), s["latest"], s["records"])], columns=["key", "status", "latest", "records"])

    return events.groupBy("key").applyInPandasWithState(run, STATUS, STATE, "update", GroupStateTimeout.NoTimeout)
