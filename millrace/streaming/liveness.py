"""Is an entity alive?  State per entity with an event-time timeout."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.session import ship_with_tasks

ship_with_tasks(__name__)


def liveness_at(df: DataFrame, entity: str, ts: str, status: str, now: Column, timeout_seconds: int) -> DataFrame:
    """Status of each entity at ``now``: LOST after a silence of more than the timeout, else the last reported."""
    beats = df.groupBy(entity).agg(F.max(F.struct(ts, status)).alias("_last"))
    silent = F.unix_micros(now) - F.unix_micros(F.col("_last")[ts].cast("timestamp"))
    lost = silent > timeout_seconds * 1_000_000
    return beats.select(
        entity, F.col("_last")[ts].alias("last_seen"),
        F.when(lost, "LOST").otherwise(F.col("_last")[status]).alias("status"),
    )


def liveness(stream: DataFrame, entity: str, ts: str, status: str, timeout_seconds: int, delay: str = "0 seconds") -> DataFrame:
    """Status changes as rows (entity, ``last_seen``, ``status``).

    An entity whose last beat is more than the timeout before the watermark is reported LOST and forgotten; its
    next beat registers it again.  A task reads the beats of an entity in Arrow batches and holds the last one.
    The watermark is ``delay`` behind the newest beat of the earlier micro-batches; beats older than it are dropped, so
    ``delay`` should be as long as beats may be late.  ``run.drain_counted`` tells how many were dropped.
    """
    beats = stream.withWatermark(ts, delay).select(entity, ts, status, F.unix_micros(ts).alias("_us"))
    kind = stream.schema[entity].dataType.simpleString()
    timeout_ms = timeout_seconds * 1000

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        def row(us: int, what: str) -> pd.DataFrame:
            return pd.DataFrame({entity: [key[0]], "us": [us], "status": [what]})

        if state.hasTimedOut:
            yield row(state.get[0], "LOST")
            state.remove()
            return
        last = tuple(state.get) if state.exists else None
        for pdf in batches:
            pdf = pdf.dropna(subset=["_us", status])
            if not len(pdf):
                continue
            newest = pdf["_us"].max()
            best = (int(newest), max(pdf[status][pdf["_us"] == newest]))
            last = best if last is None or best > last else last
        if last is None:  # nothing but rows without a time or a status
            return
        due = last[0] // 1000 + timeout_ms
        if due < state.getCurrentWatermarkMs():
            yield row(last[0], "LOST")
            if state.exists:
                state.remove()
            return
        yield row(*last)
        state.update(last)
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))

    changes = beats.groupBy(entity).applyInPandasWithState(
        follow, f"`{entity}` {kind}, us long, status string", "us long, status string",
        "append", GroupStateTimeout.EventTimeTimeout,
    )
    return changes.select(entity, F.timestamp_micros("us").alias("last_seen"), "status")


def current_status(changes: DataFrame, entity: str) -> DataFrame:
    """The last status of each entity in a log of changes; LOST comes after the beat it follows."""
    order = F.struct("last_seen", (F.col("status") == "LOST").alias("_lost"), "status")
    last = changes.groupBy(entity).agg(F.max(order).alias("_last"))
    return last.select(entity, F.col("_last.last_seen"), F.col("_last.status"))
