"""Id sets as bitmaps: a row (group, bucket, bits) holds 32,768 neighbouring ids.

Map tasks combine ids to bitmaps before the shuffle, so repeated ids cost nothing and dense ids cost a fraction of a byte
each.  Ids that are spread thin would fill many bitmaps with few bits: those keep one row per id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ids of one bitmap; the bytes of one.
BUCKET, BITMAP_BYTES = 32_768, 4096
# A bitmap pays if it holds this many rows on average; below that a row per id is smaller.
DENSE = 1024


def _bucket(value: str) -> Column:
    return F.expr(f"`{value}` div {BUCKET}").cast("long")


def is_dense(df: DataFrame, groups: list[str], value: str) -> bool:
    """Whether the ids fill their buckets: one pass over the buckets, combined in the map task."""
    seen = df.where(F.col(value).isNotNull()).groupBy(*groups, _bucket(value).alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias("_least")
    )
    buckets, rows, least = seen.agg(F.count(F.lit(1)), F.sum("_n"), F.min("_least")).first()
    return bool(buckets) and least >= 0 and rows >= DENSE * buckets


def bitmaps(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """(groups, ``bucket``, ``bits``) for non-negative ids; null ids are left out."""
    ids = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("long").alias("_id"))
    placed = ids.groupBy(*groups, F.expr(f"_id div {BUCKET}").alias("bucket"))
    return placed.agg(F.bitmap_construct_agg(F.col("_id") % BUCKET).alias("bits"))


def united(sets: list[DataFrame], groups: list[str]) -> DataFrame:
    """The union of bitmap tables."""
    rows = reduce(DataFrame.unionByName, sets)
    return rows.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def cardinality(sets: DataFrame, groups: list[str], out: str = "n") -> DataFrame:
    return sets.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(out))


def members(sets: DataFrame, groups: list[str], value: str) -> DataFrame:
    """One row per id of bitmap tables."""
    # The byte at a place as a number, then its set bits.
    byte = F.conv(F.hex(F.expr("substring(bits, _at + 1, 1)")), 16, 10).cast("int")
    bytes_ = sets.select(*groups, "bucket", "bits", F.explode(F.sequence(F.lit(0), F.lit(BITMAP_BYTES - 1))).alias("_at"))
    filled = bytes_.select(*groups, "bucket", "_at", byte.alias("_byte")).where("_byte > 0")
    bits = F.expr("filter(sequence(0, 7), b -> (shiftright(_byte, b) & 1) = 1)")
    each = filled.select(*groups, "bucket", "_at", F.explode(bits).alias("_bit"))
    return each.select(*groups, (F.col("bucket") * BUCKET + F.col("_at") * 8 + F.col("_bit")).alias(value))


def distinct_ids(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """The distinct (groups, id), by bitmaps if the ids are dense, else as rows.  Null ids are left out."""
    kind = df.schema[value].dataType
    if is_dense(df, groups, value):
        return members(bitmaps(df, groups, value), groups, value).withColumn(value, F.col(value).cast(kind))
    return df.where(F.col(value).isNotNull()).select(*groups, value).distinct()


def union_distinct(inputs: list[DataFrame], value: str) -> DataFrame:
    """Ids that occur in any input, once."""
    return distinct_ids(reduce(DataFrame.unionByName, [df.select(value) for df in inputs]), [], value)
