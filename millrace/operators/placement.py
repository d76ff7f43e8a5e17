"""Dealing ordered items to buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import row_index


def _replicas(df: DataFrame, replicas: int) -> DataFrame:
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(replicas - 1))))


def round_robin(df: DataFrame, order: list[str | Column], buckets: int, replicas: int = 1) -> DataFrame:
    """Each item in order takes the next ``replicas`` buckets; one row per copy with ``copy`` and ``bucket``."""
    placed = _replicas(row_index(df, [], order, "_at"), replicas)
    return placed.withColumn("bucket", F.pmod(F.col("_at") * replicas + F.col("copy"), F.lit(buckets)).cast("int")).drop("_at")


def contiguous(
    df: DataFrame, order: list[str | Column], buckets: int, width: int, concurrency: int, replicas: int = 1
) -> DataFrame:
    """Deal runs of neighbouring ranges to buckets; one row per item and copy.

    The items in order are cut in ranges of ``width``.  Each round gives every bucket a run of ranges that suits
    the number of items handled at once; the ranges left over are spread as evenly as possible, the first buckets
    taking one more.  Copy ``i`` goes ``i`` buckets further.  Adds ``range``, ``copy`` and ``bucket``.
    """
    items = df.count()
    at_once = min(items, concurrency)
    run = max(1, at_once // (buckets * width))
    ranges = -(-items // width)
    dealt = ranges // (run * buckets) * run * buckets
    few, more = divmod(ranges - dealt, buckets)
    placed = row_index(df, [], order, "_at")
    placed = placed.withColumn("range", ((F.col("_at") - F.pmod(F.col("_at"), F.lit(width))) / width).cast("long"))
    k, left = F.col("range"), F.col("range") - dealt
    tail = F.floor(left / (few + 1))
    if few:
        tail = F.when(left < more * (few + 1), tail).otherwise(more + F.floor((left - more * (few + 1)) / few))
    bucket = F.when(k < dealt, F.pmod(F.floor(k / run), F.lit(buckets))).otherwise(tail)
    return _replicas(placed, replicas).withColumn(
        "bucket", F.pmod(bucket + F.col("copy"), F.lit(buckets)).cast("int")
    ).drop("_at")
