"""Writing results and choosing where rows go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.ranges import range_of
from millrace.functions.text import hash_slot, range_key
from millrace.sizing import small_side


def sink_sorted_text(df: DataFrame, path: str, line: Column, *order: Column | str) -> None:
    """Write ``line`` of every row as text, in total order over the files (range shuffle, no single writer)."""
    df.orderBy(*order).select(line.cast("string").alias("value")).write.text(path)


def range_layout(df: DataFrame, part: str, width: int, count: int, out: str = "range") -> DataFrame:
    """Add the directory name ``start-end`` of the range that holds ``part``; numbers outside [0, count) fail."""
    start, end = range_of(F.col(part), width, count)
    wrong = F.raise_error(F.concat(F.lit(f"partition outside 0..{count - 1}: "), F.col(part).cast("string")))
    return df.withColumn(out, F.when(start.isNull(), wrong.cast("string")).otherwise(range_key(start, end)))


def sink_ranges(df: DataFrame, part: str, width: int, count: int, path: str) -> None:
    """Write one directory per key range.

    The rebalance hint lets AQE split a range with many rows over several tasks and join small ones.
    """
    laid = range_layout(df, part, width, count)
    laid.hint("rebalance", F.col("range")).write.partitionBy("range").parquet(path)


def route_by_size(df: DataFrame, size: Column, threshold: int, out: str = "tier") -> DataFrame:
    """``cold`` for rows larger than the threshold, else ``warm``."""
    return df.withColumn(out, F.when(size > threshold, "cold").otherwise("warm"))


def route_huge_groups(df: DataFrame, group: str, size: Column, threshold: int, out: str = "tier") -> DataFrame:
    """``cold`` for every row of a group whose total size is over the threshold, else ``warm``.

    The totals are combined before their shuffle, and only the names of huge groups meet the rows again, so one
    large group never sits in one task as it would under a window.
    """
    huge = df.groupBy(group).agg(F.sum(size).alias("_total")).where(F.col("_total") > threshold)
    huge = small_side(huge.select(F.col(group).alias("_group"), F.lit("cold").alias("_tier")), computed=True)
    joined = df.join(huge, df[group].eqNullSafe(huge["_group"]), "left")
    return joined.withColumn(out, F.coalesce("_tier", F.lit("warm"))).drop("_group", "_tier")


def sink_routed(df: DataFrame, path: str, tier: str = "tier") -> None:
    df.write.partitionBy(tier).parquet(path)


def hash_spread(df: DataFrame, keys: list[str], sinks: int, out: str = "sink") -> DataFrame:
    """Choose one of ``sinks`` targets by a hash of the key columns joined with ``_``; never negative."""
    key = F.concat_ws("_", *[F.col(k).cast("string") for k in keys])
    return df.withColumn(out, hash_slot(key, sinks).cast("int"))
