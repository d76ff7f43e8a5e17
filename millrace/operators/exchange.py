"""Moving rows between partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.session import persist_table


def by_hash(df: DataFrame, partitions: int | None, *keys: str | Column) -> DataFrame:
    """Equal keys in one partition."""
    return df.repartition(partitions, *keys) if partitions else df.repartition(*keys)


def evenly(df: DataFrame, partitions: int) -> DataFrame:
    """Rows dealt to ``partitions`` partitions."""
    return df.repartition(partitions)


def by_partitioner(df: DataFrame, partitions: int, part: Column) -> DataFrame:
    """Each row in the partition whose number the expression gives; a number outside [0, partitions) fails."""
    text = F.concat(F.lit(f"partition outside 0..{partitions - 1}: "), F.coalesce(part.cast("string"), F.lit("null")))
    inside = F.coalesce((part >= 0) & (part < partitions), F.lit(False))
    guarded = F.when(inside, part.cast("int")).otherwise(F.raise_error(text).cast("int"))
    return df.repartitionById(partitions, guarded)


def by_range(df: DataFrame, partitions: int, *keys: str | Column) -> DataFrame:
    """Disjoint key ranges, sorted inside each partition."""
    return df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)


def adaptive(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Hash exchange whose small partitions AQE merges when it sees their sizes."""
    return df.repartition(*keys)


def chained(df: DataFrame, key: str, *sizes: int, out: str = "n") -> DataFrame:
    """Exchange after exchange: rows are dealt out and counted, then the counts are dealt out again and added.

    Spark merges exchanges that follow each other directly, so each is followed by an aggregation.
    """
    counted = df.select(key, F.lit(1).cast("long").alias(out))
    for partitions in sizes:
        counted = counted.repartition(partitions).groupBy(key).agg(F.sum(out).alias(out))
    return counted


def watched(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` that reports its row count to the observation when an action runs over it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def moved(df: DataFrame, partitions: int, *keys: str) -> tuple[DataFrame, DataFrame]:
    """``df`` exchanged by key and written, and one row (``written``, ``fetched``, ``same``).

    Rows are counted as they enter the exchange, by the job that carries it out; the source is not read again to count.
    """
    entering, seen = watched(df, "entering")
    table = persist_table(by_hash(entering, partitions, *keys), "moved")
    written = seen.get["rows"]
    verdict = table.agg(F.lit(written).cast("long").alias("written"), F.count(F.lit(1)).alias("fetched"))
    return table, verdict.withColumn("same", F.col("written") == F.col("fetched"))


def conserved(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key written to and read from an exchange, and whether they agree."""
    sides = before.select(*keys, F.lit(1).alias("_w")).unionByName(after.select(*keys, F.lit(0).alias("_w")))
    counted = sides.groupBy(*keys).agg(F.sum("_w").alias("written"), F.sum(1 - F.col("_w")).alias("fetched"))
    return counted.withColumn("same", F.col("written") == F.col("fetched"))
