"""Streams of lookups: new names, states of runs, stalls, reconciliation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.status import entity_state
from ..functions.text import key_part

STALL_SECONDS = 1800


def new_names(stream: DataFrame, name: str = "company_name") -> DataFrame:
    """Each name once over the whole stream, whatever its case or spaces."""
    return stream.withColumn("name_key", key_part(F.col(name))).where("name_key <> ''").dropDuplicates(["name_key"])


def run_states(stream: DataFrame, stall_seconds: int = STALL_SECONDS) -> DataFrame:
    """(run_id, events, changes, last_state, last_change, stalled): a run's counters follow its events; a run whose fingerprint stays the
    same for longer than ``stall_seconds`` of event time stalled. stream: run_id, ts, event_type, event_id."""

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        events, changes, last, at, stalled = state.get if state.exists else (0, 0, "", 0.0, False)
        frame = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        for ts, kind in zip(frame.ts, frame.event_type, strict=True):
            seconds = ts.timestamp()
            if events and seconds - at > stall_seconds:
                stalled = True
            events += 1
            changes += kind != last
            last, at = kind, seconds
        state.update((events, changes, last, at, stalled))
        yield pd.DataFrame({"run_id": [key[0]], "events": [events], "changes": [changes], "last_state": [last], "stalled": [stalled]})

    return stream.groupBy("run_id").applyInPandasWithState(
        step, "run_id long, events long, changes long, last_state string, stalled boolean", "events long, changes long, last string, at double, stalled boolean", "update", GroupStateTimeout.NoTimeout
    )


def run_states_batch(events: DataFrame, stall_seconds: int = STALL_SECONDS) -> DataFrame:
    """The same over a finished table, by windows."""
    order = Window.partitionBy("run_id").orderBy("ts", "event_id")
    rows = events.withColumns({"_kind": F.lag("event_type").over(order), "_ts": F.lag("ts").over(order)})
    gap = F.col("ts") - F.col("_ts") > F.expr(f"interval {stall_seconds} seconds")
    return rows.groupBy("run_id").agg(
        F.count("*").alias("events"), F.count_if(F.col("_kind").isNull() | (F.col("_kind") != F.col("event_type"))).alias("changes"),
        F.max_by("event_type", F.struct("ts", "event_id")).alias("last_state"), F.coalesce(F.max(gap), F.lit(False)).alias("stalled"),
    )


def sessions(events: DataFrame, gap: str = "1800 seconds") -> DataFrame:
    """Sessions of a run's events."""
    return events.groupBy("run_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("events"), F.count_if(entity_state(F.col("event_type")) == "failed").alias("failed"))


def on_each_batch(handle: Callable[[DataFrame], None], warnings: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch body: a callback that fails leaves a warning and doesn't stop the stream."""

    def run(batch: DataFrame, number: int) -> None:
        try:
            handle(batch)
        except Exception as problem:  # the callback is the caller's code
            warnings.append(f"batch {number}: {problem}")

    return run


def reconcile(current: DataFrame, refreshed: DataFrame, keys: list[str], digest: Callable[[DataFrame], str]) -> tuple[DataFrame, bool]:
    """Refreshed rows replace current ones of the same key; whether the digest changed, so that analysis must run again."""
    after = current.join(refreshed, keys, "left_anti").unionByName(refreshed)
    return after, digest(current) != digest(after)
