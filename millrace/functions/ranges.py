"""Fixed-width closed ranges of partition numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def range_start(p: Column, width: int) -> Column:
    return (p - F.pmod(p, F.lit(width))).cast("long")


def range_end(p: Column, width: int) -> Column:
    return range_start(p, width) + F.lit(width - 1)


def range_of(p: Column, width: int, count: int) -> tuple[Column, Column]:
    """Start and end of the range that holds ``p``; null for a number outside [0, count)."""
    inside = (p >= 0) & (p < count)
    return F.when(inside, range_start(p, width)), F.when(inside, range_end(p, width))
