"""What the operators of this subpackage share: the query registry, table access, batch bounds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# What one Arrow batch may hold; bounds the memory of a Python worker whatever the length of texts.
BATCH_ROWS, BATCH_BYTES = 50_000, 8 << 20


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Cut Arrow batches by size: many narrow rows to a batch, few long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id's text mod 4 is 2.  A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents that are not held out.

    The ids are those of smallest hash, so the choice is the same at every run.  Null labels and ids are left out; a
    document labelled twice, or present twice, counts each time.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    )
    # At most ``rows`` pairs of numbers, so safe to send everywhere.
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
