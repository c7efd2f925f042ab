"""Stateful streams whose results don't depend on how the input was cut into batches.

Rows of a key wait in state until the watermark has passed them, and are then folded
in event-time order; what falls due between two of them, or after the last, falls due
at its own time.  So every cut of the input, with rows out of order by less than the
watermark's delay, gives the rows that a fold over the sorted table gives.  Later rows
are dropped by the watermark, as everywhere in Spark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Fold:
    """A fold over one key's events in order.  Times are milliseconds.

    ``state`` is a dictionary that JSON can hold, empty at first.
    """

    #: Columns of a row that the fold reads, besides ``at`` and ``event_id``.
    reads: list[str] = []
    #: Schema of what it emits, without the key.
    emits = ""

    def due(self, state: dict) -> int | None:
        """When something happens without an event."""
        return None

    def expire(self, state: dict, at: int) -> list[tuple]:
        """What happens then; changes ``state`` so that ``due`` is later or none."""
        return []

    def event(self, state: dict, at: int, row: tuple) -> list[tuple]:
        raise NotImplementedError


def run_fold(fold: Fold, state: dict, events: list, until: int) -> list[tuple]:
    """Events (at, event_id, *reads) in order, then what falls due before ``until``; an event at the due time comes first."""
    out = []
    for at, _, *row in sorted(events):
        while (due := fold.due(state)) is not None and due < at:
            out += fold.expire(state, due)
        out += fold.event(state, at, tuple(row))
    while (due := fold.due(state)) is not None and due < until:
        out += fold.expire(state, due)
    return out


class _Ordered(StatefulProcessor):
    def __init__(self, fold: Fold, keys: list[str], columns: list[str]):
        self.fold, self.keys, self.columns = fold, keys, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("fold", "value string")
        self.waiting = handle.getListState("waiting", "value string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [r for frame in rows for r in frame[["at", "event_id", *self.fold.reads]].itertuples(index=False, name=None)]
        self.waiting.appendList([(json.dumps([None if pd.isna(v) else getattr(v, "item", lambda v=v: v)() for v in r]),) for r in new])
        # rows before the watermark were dropped, so none of these can be folded yet
        self.handle.registerTimer(max(min(int(r[0]) for r in new), timerValues.getCurrentWatermarkInMs()))
        yield pd.DataFrame(columns=self.columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        state = json.loads(self.state.get()[0]) if self.state.exists() else {}
        waiting = [json.loads(r[0]) for r in self.waiting.get()] if self.waiting.exists() else []
        ready, later = [r for r in waiting if r[0] < now], [r for r in waiting if r[0] >= now]
        found = run_fold(self.fold, state, ready, now)
        self.state.update((json.dumps(state),))
        if later:
            self.waiting.put([(json.dumps(r),) for r in later])
        else:
            self.waiting.clear()
        due = self.fold.due(state)
        for at in {min(r[0] for r in later)} if later else set():
            self.handle.registerTimer(at)
        if due is not None:
            self.handle.registerTimer(due)
        yield pd.DataFrame([(*key, *row) for row in found], columns=self.columns)

    def close(self) -> None:
        pass


def ordered_fold(events: DataFrame, keys: list[str], fold: Fold, delay: str) -> DataFrame:
    """The fold's rows as a stream in append mode; ``events`` has the keys, ts, event_id and what the fold reads.

    Keys travel as one JSON text, in which a null key is one that is not there: state
    is kept by values that are never null.
    """
    types = dict(events.dtypes)
    columns = ["key", *[part.split()[0] for part in fold.emits.split(", ")]]
    rows = events.withWatermark("ts", delay).select("ts", F.to_json(F.struct(*keys)).alias("key"), F.unix_millis("ts").alias("at"), "event_id", *fold.reads)
    out = rows.groupBy("key").transformWithStateInPandas(_Ordered(fold, keys, columns), f"key string, {fold.emits}", "append", "eventtime")
    key = F.from_json("key", ", ".join(f"{k} {types[k]}" for k in keys))
    return out.select(*[key[k].alias(k) for k in keys], *columns[1:])


def folded(events: DataFrame, keys: list[str], fold: Fold, until: int) -> DataFrame:
    """The same fold over a table: all events before ``until``, and what falls due before it."""
    types = dict(events.dtypes)
    schema = ", ".join([*[f"{k} {types[k]}" for k in keys], fold.emits])
    columns = [part.split()[0] for part in schema.split(", ")]
    reads = ["at", "event_id", *fold.reads]

    def step(key, frame):
        events = [tuple(None if pd.isna(v) else v for v in r) for r in frame[reads].itertuples(index=False, name=None)]
        return pd.DataFrame([(*key, *row) for row in run_fold(fold, {}, events, until)], columns=columns)

    rows = events.withColumn("at", F.unix_millis("ts")).filter(F.col("at") < until)
    return rows.groupBy(*keys).applyInPandas(step, schema)


class IssueLifecycle(Fold):
    """Issues open when a condition is observed and close when it is found healthy or no longer seen.

    Kinds of events: ``observed`` inserts, updates, or reopens a closed issue, which
    then counts as observed first anew; ``cleared`` closes an open one; ``wont_fix``
    suppresses an open one for good, after which observations only refresh it.  An open
    issue that isn't observed for ``forget`` closes by itself.
    """

    reads = ["kind"]
    emits = "at long, action string, status string, first_observed long, last_observed long, resolved_by string"

    def __init__(self, forget: int):
        self.forget = forget

    def due(self, state: dict) -> int | None:
        return state["last"] + self.forget if state.get("status") == "open" else None

    def _row(self, state: dict, at: int, action: str, by: str | None = None) -> list[tuple]:
        return [(at, action, state["status"], state["first"], state["last"], by)]

    def expire(self, state: dict, at: int) -> list[tuple]:
        state["status"] = "resolved"
        return self._row(state, at, "closed", "not-observed")

    def event(self, state: dict, at: int, row: tuple) -> list[tuple]:
        kind, status = row[0], state.get("status")
        if kind == "observed":
            action = {None: "inserted", "resolved": "reopened"}.get(status, "updated")
            if action != "updated":
                state.update(status="open", first=at)
            state["last"] = at
            return self._row(state, at, action)
        if status != "open" or kind not in ("cleared", "wont_fix"):
            return []
        state["status"] = "resolved" if kind == "cleared" else "wont_fix"
        return self._row(state, at, "closed" if kind == "cleared" else "suppressed", "auto-cleared" if kind == "cleared" else "operator")


class Silence(Fold):
    """A key is silent once nothing has come from it for ``after``; its next event ends that.

    A key that never came has no baseline and isn't judged.
    """

    emits = "at long, state string, last_seen long"

    def __init__(self, after: int):
        self.after = after

    def due(self, state: dict) -> int | None:
        return state["last"] + self.after if state and not state["silent"] else None

    def expire(self, state: dict, at: int) -> list[tuple]:
        state["silent"] = True
        return [(at, "silent", state["last"])]

    def event(self, state: dict, at: int, row: tuple) -> list[tuple]:
        out = [(at, "running", state["last"])] if state.get("silent") else []
        state.update(last=at, silent=False)
        return out
