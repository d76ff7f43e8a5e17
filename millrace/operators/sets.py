"""Set and bag operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_set(inputs: list[DataFrame]) -> DataFrame:
    """Ids that occur in any input, once."""
    return reduce(DataFrame.unionByName, inputs).distinct()


def union_bag(inputs: list[DataFrame]) -> DataFrame:
    """All rows of all inputs, repeats kept."""
    return reduce(DataFrame.unionByName, inputs)


def intersect_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that ``a`` and ``b`` do not have equally often, with their counts ``n_a`` and ``n_b``.

    Empty if and only if both hold the same bag of rows.  One exchange; equal rows are counted before it.
    """
    columns = a.columns
    sides = a.withColumn("_side", F.lit(0)).unionByName(b.withColumn("_side", F.lit(1)))
    counted = sides.groupBy(*columns).agg(
        F.sum(1 - F.col("_side")).alias("n_a"), F.sum("_side").alias("n_b")
    )
    return counted.where(F.col("n_a") != F.col("n_b"))
