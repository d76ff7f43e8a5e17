"""Streams that built-in stateful operators express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def st_dedupe(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Each key once, if its repeats come within ``delay`` of event time.

    A row older than the watermark is dropped, also if its key never came before; ``history.dedupe_ever`` keeps it.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def idle_stream(stream: DataFrame, entity: str, ts: str, ttl_seconds: int, delay: str = "0 seconds") -> DataFrame:
    """Sessions that ended because the entity was idle for more than the TTL; emitted once they are over.

    A row exactly TTL after the previous one still belongs to its session, hence the extra microsecond.  Rows more than
    ``delay`` behind the newest row of the earlier micro-batches are dropped; ``run.drain_counted`` counts them.
    """
    gap = f"{ttl_seconds} seconds 1 microseconds"
    sessions = stream.withWatermark(ts, delay).groupBy(entity, F.session_window(ts, gap).alias("_w"))
    return sessions.agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count(F.lit(1)).alias("n")).drop("_w")


def totals(stream: DataFrame, labels: list[str], measures: dict[str, Column]) -> DataFrame:
    """Counters and gauges by label; run with ``run.latest``."""
    return stream.groupBy(*labels).agg(*[m.alias(n) for n, m in measures.items()])


def split_rejected(
    stream: DataFrame, owners: DataFrame, owner: str, ts: str | None = None, until: str | None = None
) -> DataFrame:
    """Rows with ``accepted``: whether their owner is known and, given ``until``, was not expired at the row's time."""
    known = owners.select(F.col(owner).alias("_owner"), *([until] if until else [])).dropDuplicates(["_owner"])
    joined = stream.join(known, stream[owner] == known["_owner"], "left")
    fine = F.col("_owner").isNotNull()
    if until:
        fine = fine & (F.col(until).isNull() | (F.col(ts) <= F.col(until)))
    return joined.select(*stream.columns, F.coalesce(fine, F.lit(False)).alias("accepted"))
