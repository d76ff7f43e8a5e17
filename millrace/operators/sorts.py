"""Total and partial orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import word_count
from millrace.operators.ordered import row_index
from millrace.session import persist_table
from millrace.sizing import biggest_group, group_row_limit


def sort_global(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Total order over all partitions: range exchange, then a sort in each partition."""
    return df.orderBy(*keys)


def secondary_sort(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows grouped by ``first`` and ordered by ``second`` inside each group.

    Placed by ranges of (first, second): a group is contiguous, and one that is too large for a partition goes on
    in the next ones.
    """
    return df.repartitionByRange(F.col(first), F.col(second)).sortWithinPartitions(first, second)


def position_in_group(df: DataFrame, group: str, order: list[str], out: str = "pos") -> DataFrame:
    """The rank a row has after ``secondary_sort``; rows with equal order values follow one another in no stated order.

    If a group is too large for one task, rows are numbered and written first, so that equal ones are split as well.
    """
    if biggest_group(df, [group]) <= group_row_limit(df.sparkSession):
        return row_index(df, [group], order, out)
    numbered = persist_table(df.withColumn("_tie", F.monotonically_increasing_id()), "ties")
    return row_index(numbered, [group], [*order, "_tie"], out).drop("_tie")


def ordered_count(df: DataFrame, col: str) -> DataFrame:
    """Words by ascending number of occurrences, equal counts by word."""
    return word_count(df, col).orderBy("n", "word")


def local_sort(df: DataFrame, part: Column, partitions: int, *keys: str | Column) -> DataFrame:
    """Rows in the partition that ``part`` names, sorted inside it."""
    return df.repartitionById(partitions, part.cast("int")).sortWithinPartitions(*keys)


def local_position() -> Column:
    """0-based position of a row in its partition, as the partition is ordered now."""
    return F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)


def largest(df: DataFrame, size: str, k: int, *tie: str) -> DataFrame:
    """The ``k`` largest rows; each partition keeps its ``k`` before they are merged."""
    return df.orderBy(F.col(size).desc(), *tie).limit(k)
