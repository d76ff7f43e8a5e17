"""Equi-joins under a chosen strategy, semi and anti joins, the bag product and the N-way merge."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import collect_pages
from millrace.session import persist_table
from millrace.sizing import small_side


def join_smj(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Sort-merge join.  Under AQE a partition that a hot key makes large is read by several tasks."""
    return left.join(right.hint("merge"), on, how)


def join_hash(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Partitioned hash join that builds on the right side, which should be the smaller one."""
    return left.join(right.hint("shuffle_hash"), on, how)


def join_bcast(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """The right side goes to every task if a count proves it small; else a shuffle join."""
    return left.join(small_side(right), on, how)


# Cells a hot key is cut into for each average task of work it brings; more cells even out, fewer copy less.
CELLS = 16


def join_salted(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner join that spreads keys that are hot on either side, or on both, over many tasks.

    The work of a key is its rows on both sides and the pairs they make.  A key with more than two tasks' share of all
    work is hot, so hot keys are fewer than half the shuffle partitions and their list can be sent to all tasks.  The
    pairs of a hot key form a grid: its rows on the left are dealt to r parts, those on the right to c parts, in turn,
    and each part meets each part of the other side in one cell, so a left row is sent c times and a right row r
    times.  r and c follow the row counts, which keeps those copies few.  Rows are dealt by numbers that are written
    with them once: equal rows go to different parts, and a task that runs again deals them as before.  Other keys join
    as they are.
    """
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = [df.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).cast("double").alias(n)) for df, n in ((left, "_l"), (right, "_r"))]
    work = persist_table(sides[0].join(sides[1], on).withColumn("_work", F.col("_l") + F.col("_r") + F.col("_l") * F.col("_r")), "work")
    share = (work.agg(F.sum("_work")).first()[0] or 0.0) / partitions
    cells = F.ceil(F.col("_work") / share * CELLS) if share else F.lit(1)
    hot = work.where(F.col("_work") > 2 * share).withColumn("_cells", cells)
    rows = F.least(F.col("_l"), F.greatest(F.lit(1.0), F.round(F.sqrt(F.col("_cells") * F.col("_l") / F.col("_r")))))
    hot = hot.withColumn("_rows", rows.cast("long"))
    columns = F.least(F.col("_r"), F.ceil(F.col("_cells") / F.col("_rows")))
    hot = persist_table(hot.select(on, "_rows", columns.cast("long").alias("_columns")), "hot")
    # Without hot keys the plan is a plain join.
    if hot.isEmpty():
        return left.join(right, on)
    keys = F.broadcast(hot)
    cold = left.join(keys, on, "left_anti").join(right.join(F.broadcast(hot), on, "left_anti"), on)

    met = _dealt(left, keys, on, "_rows", "_columns").join(_dealt(right, keys, on, "_columns", "_rows"), [on, "_cell_rows", "_cell_columns"])
    met = met.drop("_cell_rows", "_cell_columns")
    return cold.unionByName(met)


def _dealt(df: DataFrame, hot: DataFrame, on: str, mine: str, others: str) -> DataFrame:
    """Rows of hot keys with the part each is dealt to, once for every part of the other side."""
    numbered = persist_table(df.join(hot, on).withColumn("_n", F.monotonically_increasing_id()), "dealt")
    placed = numbered.withColumn("_cell" + mine, F.pmod("_n", F.col(mine)))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1))
    return placed.withColumn("_cell" + others, copies).drop("_n", "_rows", "_columns")


def cross(inputs: list[DataFrame], names: list[str], copies: str = "n") -> DataFrame:
    """All combinations of one column of each input, as a bag: each combination once, with its number of copies.

    Equal values of an input are counted first, so the work grows with the distinct values; the product itself is what
    the caller asks for.  Spark chooses how to carry it out.  ``copies`` is a long; if the largest number of copies is
    beyond a long, the column is decimal(38,0) instead, so the counts stay exact.
    """
    bags = [
        persist_table(df.groupBy(F.col(df.columns[0]).alias(name)).agg(F.count(F.lit(1)).alias(f"_n{i}")), "bag")
        for i, (df, name) in enumerate(zip(inputs, names))
    ]
    most = math.prod(bag.agg(F.max(f"_n{i}")).first()[0] or 0 for i, bag in enumerate(bags))
    kind = "long" if most < 1 << 63 else "decimal(38,0)"
    product = reduce(lambda a, b: a.crossJoin(b), bags)
    total = reduce(lambda a, b: a * b, [F.col(f"_n{i}").cast(kind) for i in range(len(bags))])
    return product.select(*names, total.cast(kind).alias(copies))


def keep_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose id is in the set."""
    return df.join(small_side(ids.select(on).distinct(), computed=True), on, "left_semi")


def missing(expected: DataFrame, got: DataFrame, on: str) -> DataFrame:
    """Expected ids that were not delivered.

    Both sides are combined to distinct ids before the shuffle, so a repeated id costs one row per map task.
    """
    return expected.select(on).distinct().join(got.select(on).distinct(), on, "left_anti")


def orphans(stored: DataFrame, live: DataFrame, on: str) -> DataFrame:
    """Stored rows whose owner is not live."""
    return stored.join(live.select(on).distinct(), on, "left_anti")


def cogroup_n(inputs: list[DataFrame], key: str, value: str, page_rows: int = 10_000) -> DataFrame:
    """N inputs merged by key: the values of equal keys together, in pages (see ``collect_pages``)."""
    merged = reduce(DataFrame.unionByName, [df.select(key, value) for df in inputs])
    return collect_pages(merged, [key], value, page_rows)
