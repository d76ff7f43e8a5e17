"""Was everything delivered, once, intact?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import crc32
from millrace.sizing import small_side


def audit_complete(expected: DataFrame, got: DataFrame, group: str, key: str) -> DataFrame:
    """Per group: how many expected ids there are, how many of them arrived, and whether that is all.

    Rows that nobody expects are ignored.  One exchange by id and one by group; each combines first.
    """
    sides = expected.select(group, key, F.lit(1).alias("_e"), F.lit(0).alias("_g")).unionByName(
        got.select(group, key, F.lit(0).alias("_e"), F.lit(1).alias("_g"))
    )
    ids = sides.groupBy(group, key).agg(F.max("_e").alias("_e"), F.max("_g").alias("_g")).where("_e = 1")
    out = ids.groupBy(group).agg(F.count(F.lit(1)).alias("expected"), F.sum("_g").alias("actual"))
    return out.withColumn("complete", F.col("expected") == F.col("actual"))


def verify_crc(df: DataFrame, payload: Column, stored: Column) -> DataFrame:
    """Rows whose stored checksum is not that of the payload, with the checksum found."""
    return df.withColumn("actual_crc", crc32(payload)).where(~stored.eqNullSafe(F.col("actual_crc")))


def audit_delivery(
    ledger: DataFrame, expected: DataFrame, accepted: DataFrame, group: str, key: str, attempt: str, intact: Column
) -> DataFrame:
    """One verdict per group: of the copies that accepted attempts wrote, is a good one there for each expected id?

    ``expected`` has group and key.  Adds to ``audit_complete`` the number of damaged copies seen.  One pass over the
    ledger; repeated and damaged copies of an id are combined before its exchange.
    """
    kept = ledger.join(small_side(accepted.select(attempt).distinct(), computed=True), attempt, "left_semi")
    fine = F.when(F.coalesce(intact, F.lit(False)), 1).otherwise(0)
    sides = expected.select(group, key, F.lit(1).alias("_e"), F.lit(0).alias("_g"), F.lit(0).alias("_d")).unionByName(
        kept.select(group, key, F.lit(0).alias("_e"), fine.alias("_g"), (1 - fine).alias("_d"))
    )
    ids = sides.groupBy(group, key).agg(F.max("_e").alias("_e"), F.max("_g").alias("_g"), F.sum("_d").alias("_d"))
    out = ids.groupBy(group).agg(
        F.sum("_e").alias("expected"), F.sum(F.col("_e") * F.col("_g")).alias("actual"), F.sum("_d").alias("damaged")
    )
    out = out.where(F.col("expected") > 0)
    return out.withColumn("complete", F.col("expected") == F.col("actual"))


def retry_flags(df: DataFrame, parent: str, group: str, attempt: str, maximum: int) -> DataFrame:
    """Failures of each group in the newest attempt of its parent, and whether they reach ``maximum``."""
    counted = df.groupBy(parent, group, attempt).agg(F.count(F.lit(1)).alias("failures"))
    newest = counted.groupBy(parent).agg(F.max(attempt).alias(attempt))
    current = counted.join(newest, [parent, attempt], "left_semi")
    return current.withColumn("flagged", F.col("failures") >= maximum)
