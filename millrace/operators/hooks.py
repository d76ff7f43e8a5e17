"""Places for a user's own functions: they get Arrow batches, never single rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import first_rows, row_index
from millrace.session import ship_with_tasks

ship_with_tasks(__name__)


def flat_map(df: DataFrame, schema: str, function: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Any number of rows out for the rows in.  Prefer column expressions where they can say it."""
    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return map(function, batches)

    return df.mapInPandas(over, schema)


def numbered_by(df: DataFrame, group: Column, order: list[Column], out: str = "pos") -> DataFrame:
    """Position of each row under a grouping and a sort comparator, given as key expressions."""
    keys = {f"_order{i}": o for i, o in enumerate(order)}
    keyed = df.withColumns({"_group": group, **keys})
    return row_index(keyed, ["_group"], list(keys), out).drop("_group", *keys)


def heads_by(df: DataFrame, group: Column, order: list[Column]) -> DataFrame:
    """The first row of each group of a grouping comparator."""
    return first_rows(df.withColumn("_group", group), ["_group"], order).drop("_group")


def table_function(df: DataFrame, function: type, schema: str, part: list[str], order: list[str | Column]) -> DataFrame:
    """A user's table function: ``function().eval(row)`` for the rows of a group in order, then ``terminate()``.

    Both may yield rows of ``schema``.  Rows pass one at a time, so a group is never held; each group has an object of its
    own.
    """
    call = F.udtf(function, returnType=schema)
    ordered = [F.col(o) if isinstance(o, str) else o for o in order]
    return call(df.asTable().partitionBy(*[F.col(p) for p in part]).orderBy(*ordered))
