"""Streams with state per key, held in Spark's state store: a micro-batch reads and writes the keys it meets, no others."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from millrace.session import persist_table, scratch_path, ship_with_tasks
from millrace.streaming.run import _path, _schema

ship_with_tasks(__name__)

# State variables need this store; changes are logged by key instead of writing whole snapshots.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# No quota of its own.
NONE = -1


class KeyedRun:
    """A keyed stream run over all input there is: what it wrote, its state, and the progress of each micro-batch."""

    def __init__(self, stream: DataFrame, label: str):
        self.spark, self.base = stream.sparkSession, scratch_path(stream.sparkSession, label)
        before = {key: self.spark.conf.get(key, None) for key in STORE}
        for key, value in STORE.items():
            self.spark.conf.set(key, value)
        try:
            query = (
                stream.writeStream.format("parquet").outputMode("append").option("path", f"{self.base}/out")
                .option("checkpointLocation", f"{self.base}/progress").trigger(availableNow=True).start()
            )
            query.awaitTermination()
            self.progress = query.recentProgress
        finally:
            for key, value in before.items():
                if value is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, value)
        self.output = self.spark.read.schema(stream.schema).parquet(f"{self.base}/out")

    def state(self, variable: str, schema: str, *columns: str) -> DataFrame:
        """The rows of a state variable after the last micro-batch, as ``columns`` of type ``schema``."""
        where, system = _path(self.spark, f"{self.base}/progress/state")
        if not system.exists(where):
            return self.spark.createDataFrame([], _schema(schema))
        kept = self.spark.read.format("statestore").option("path", f"{self.base}/progress").option("stateVarName", variable).load()
        names = [f.name for f in _schema(schema)]
        return persist_table(kept.select(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)]), variable)


def _moment(stream: DataFrame, ts: str) -> tuple:
    """A time or number as a long, and how to turn the long back."""
    kind = stream.schema[ts].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(ts).cast("timestamp")), lambda c: F.timestamp_micros(c).cast(kind)
    if not isinstance(kind, T.IntegralType):
        raise ValueError(f"{ts} must be a time or a whole number")
    return F.col(ts).cast("long"), lambda c: c.cast(kind)


def _as_text(column: str) -> Column:
    """A value as text, also a null: pandas would turn whole numbers beside a null into floats."""
    return F.coalesce(F.concat(F.lit("+"), F.col(column).cast("string")), F.lit("-"))


def _from_text(column: Column, kind: str) -> Column:
    return F.when(F.startswith(column, F.lit("+")), F.substring(column, 2, 1 << 30)).cast(kind)


class _Quota(StatefulProcessor):
    """One owner: its live entities with when they were last seen, and its quota if it has one of its own."""

    def __init__(self, default: int, ttl: int | None, timers: bool):
        self.default, self.ttl, self.timers = default, ttl, timers

    def init(self, handle) -> None:
        self.handle = handle
        self.live = handle.getMapState("live", "entity string", "seen long")
        self.own = handle.getValueState("quota", "quota int")

    def _expire(self, now: int) -> None:
        for (entity,), (seen,) in list(self.live.iterator()):
            if now - seen > self.ttl:
                self.live.removeKey((entity,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        met, given = {}, -1
        for batch in rows:
            for entity, at, quota, news in zip(batch["entity_"], batch["at_"], batch["quota_"], batch["news_"], strict=True):
                if news:
                    # A line for an owner holds until the next one; without a number the default holds again.
                    self.own.clear() if quota < 0 else self.own.update((int(quota),))
                else:
                    at, given = int(at), int(quota)
                    first, last = met.get(entity, (at, at))
                    met[entity] = min(first, at), max(last, at)
        if not met:
            return
        if self.ttl is not None:
            self._expire(min(first for first, _ in met.values()))
        live = {entity for (entity,) in self.live.keys()}
        own = self.own.get()
        quota = own[0] if own is not None else given if given >= 0 else self.default
        room = quota - len(live)
        fresh = ((first, entity) for entity, (first, _) in met.items() if entity not in live)
        admitted = {entity for _, entity in heapq.nsmallest(max(0, room), fresh)} | (live & met.keys())
        for entity in admitted:
            self.live.updateValue((entity,), (max(met[entity][1], self.live.getValue((entity,))[0] if entity in live else met[entity][1]),))
        if self.timers and (admitted or live):
            self._wake()
        names = list(met)
        yield pd.DataFrame({
            "owner": [key[0]] * len(names), "entity": names, "first": [met[e][0] for e in names], "last": [met[e][1] for e in names],
            "admitted": [e in admitted for e in names],
        })

    def _wake(self) -> None:
        """One timer, when the entity seen longest ago may go."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        oldest = min((seen for _, (seen,) in self.live.iterator()), default=None)
        if oldest is not None:
            self.handle.registerTimer((oldest + self.ttl) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._expire(timerValues.getCurrentWatermarkInMs() * 1000)
        self._wake()
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def quota_run(
    stream: DataFrame, owner: str, entity: str, ts: str, overrides: DataFrame, default: int, ttl_seconds: int | None = None,
    delay: str | None = None,
) -> tuple[KeyedRun, DataFrame, DataFrame]:
    """See ``folds.quota``; also returns the run itself."""
    owner_kind, entity_kind = (stream.schema[c].dataType.simpleString() for c in (owner, entity))
    at, back = _moment(stream, ts)
    # Rows without a time are not judged.
    rows = stream.where(F.col(ts).isNotNull()).select(F.col(owner).alias("owner_"), _as_text(entity).alias("entity_"), F.col(ts).alias("ts_"), at.alias("at_"))
    timers = ttl_seconds is not None and delay is not None
    if timers:
        rows = rows.withWatermark("ts_", delay)
    news = overrides.select(F.col(owner).cast(owner_kind).alias("owner_"), F.coalesce(F.col("quota").cast("int"), F.lit(NONE)).alias("quota_"))
    if overrides.isStreaming:
        blank = {"entity_": F.lit("-"), "ts_": F.lit(0).cast(rows.schema["ts_"].dataType), "at_": F.lit(0).cast("long")}
        lines = news.withColumns(blank).withColumn("news_", F.lit(True))
        rows = rows.withColumns({"quota_": F.lit(NONE), "news_": F.lit(False)}).unionByName(lines)
    else:
        # A fixed table: each row brings its owner's quota along.
        rows = rows.join(news, "owner_", "left").withColumns({"quota_": F.coalesce("quota_", F.lit(NONE)), "news_": F.lit(False)})
    processor = _Quota(default, None if ttl_seconds is None else ttl_seconds * 1_000_000, timers)
    found = rows.groupBy("owner_").transformWithStateInPandas(
        processor, f"owner {owner_kind}, entity string, first long, last long, admitted boolean", "Append", "EventTime" if timers else "None"
    )
    verdicts = found.select(F.col("owner").alias(owner), _from_text(F.col("entity"), entity_kind).alias(entity), back(F.col("first")).alias("first_seen"), back(F.col("last")).alias("last_seen"), "admitted")
    run = KeyedRun(verdicts, "quota")
    state = run.state("live", f"`{owner}` {owner_kind}, `{entity}` string, _seen long", "key.owner_", "user_map_key.entity", "user_map_value.seen")
    return run, run.output, state.withColumns({entity: _from_text(F.col(entity), entity_kind), "seen": back(F.col("_seen"))}).drop("_seen")


class _Retries(StatefulProcessor):
    """One parent: its newest attempt, and the failures of each group in it."""

    def __init__(self, maximum: int):
        self.maximum = maximum

    def init(self, handle) -> None:
        self.newest = handle.getValueState("newest", "attempt long")
        self.failures = handle.getMapState("failures", "group string", "attempt long, failures long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        counts: dict = {}
        for batch in rows:
            for name, n in batch.groupby(["attempt_", "group_"]).size().items():
                counts[name] = counts.get(name, 0) + int(n)
        newest = self.newest.get()
        newest, fired = newest[0] if newest is not None else None, []
        for attempt, group in sorted(counts):
            n, attempt = counts[attempt, group], int(attempt)
            if newest is not None and attempt < newest:
                continue
            if newest is None or attempt > newest:
                self.failures.clear()
                newest = attempt
            had = self.failures.getValue((group,))[1] if self.failures.containsKey((group,)) else 0
            self.failures.updateValue((group,), (attempt, had + n))
            if had < self.maximum <= had + n:
                fired.append((key[0], group, attempt, had + n))
        if newest is not None:
            self.newest.update((newest,))
        yield pd.DataFrame(fired, columns=["parent", "group", "attempt", "failures"]) if fired else pd.DataFrame()

    def close(self) -> None:
        pass


def retry_run(stream: DataFrame, parent: str, group: str, attempt: str, maximum: int) -> tuple[KeyedRun, DataFrame, DataFrame]:
    """See ``folds.retry_counter``; also returns the run itself."""
    kinds = [stream.schema[c].dataType.simpleString() for c in (parent, group, attempt)]
    rows = stream.where(F.col(attempt).isNotNull()).select(
        F.col(parent).alias("parent_"), _as_text(group).alias("group_"), F.col(attempt).cast("long").alias("attempt_")
    )
    fired = rows.groupBy("parent_").transformWithStateInPandas(
        _Retries(maximum), f"parent {kinds[0]}, group string, attempt long, failures long", "Append", "None"
    )
    fired = fired.select(F.col("parent").alias(parent), _from_text(F.col("group"), kinds[1]).alias(group), F.col("attempt").cast(kinds[2]).alias(attempt), "failures")
    run = KeyedRun(fired, "retries")
    ddl = f"`{parent}` {kinds[0]}, `{group}` string, `{attempt}` long, failures long"
    left = run.state("failures", ddl, "key.parent_", "user_map_key.group", "user_map_value.attempt", "user_map_value.failures")
    return run, run.output, left.withColumns({group: _from_text(F.col(group), kinds[1]), attempt: F.col(attempt).cast(kinds[2])})
