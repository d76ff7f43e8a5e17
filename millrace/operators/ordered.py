"""Running values over rows in order, per group, for groups of any size.

A window puts all rows of a group in one task.  That is right while groups are small; when a count shows a group
(or the whole table, if it is not grouped) above ``sizing.group_row_limit``, the table is range-partitioned by
group and order instead, so a large group spans many slices.  Running values are computed inside each slice and
then shifted by what the earlier slices of the same group add up to.  Only the first group of a slice can have
earlier slices, so there are fewer shifts than slices: that table is the one that is broadcast.

The order columns should decide the order of any two rows of a group; equal rows land in one slice.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import persist_table
from millrace.sizing import biggest_group, group_byte_limit, group_row_limit, heaviest_group, small_side

SLICE = "_slice"


def first_rows(
    df: DataFrame, key: list[str], order: list[str | Column], n: int = 1, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of every key in the given order.

    Spark limits every map task's rows per key to ``n`` before the shuffle (WindowGroupLimit), so a hot key sends
    at most ``n`` rows per map task.  It does so up to a setting; above that, large groups are split.
    """
    name = rank or "_rn"
    if n <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    else:
        # Filtered as it is, a LONG: the rank of a row in a very large group need not fit an INT.
        ranked = row_index(df, key, order, name).withColumn(name, F.col(name) + 1)
    top = ranked.where(F.col(name) <= n).withColumn(name, F.col(name).cast("int"))
    return top if rank else top.drop(name)


def sliced(df: DataFrame, part: list[str], order: list[str | Column], by_bytes: bool = False) -> DataFrame:
    """``df`` with a column ``_slice`` that grows with (part, order), written so that every pass sees the same slices.

    A slice holds about half the row limit of one task, and with ``by_bytes`` at most about half its byte limit.
    """
    rows, size = heaviest_group(df, []) if by_bytes else (df.count(), 0)
    slices = max(2, math.ceil(2 * rows / group_row_limit(df.sparkSession)), math.ceil(2 * size / group_byte_limit(df.sparkSession)))
    placed = df.repartitionByRange(slices, *part, *order).withColumn(SLICE, F.spark_partition_id().cast("long"))
    return persist_table(placed, "slices")


def with_slices(
    df: DataFrame, part: list[str], order: list[str | Column], counted: DataFrame | None = None, by_bytes: bool = False
) -> tuple[DataFrame, bool]:
    """``df`` with ``_slice`` (0 everywhere if no group is too large for one task), and whether it was split.

    ``counted`` is a frame that is cheaper to count and whose groups are at least as large.  ``by_bytes`` looks at the bytes
    of groups too, for rows that may be wide.
    """
    rows, size = heaviest_group(df, part) if by_bytes else (biggest_group(df if counted is None else counted, part), 0)
    if rows <= group_row_limit(df.sparkSession) and size <= group_byte_limit(df.sparkSession):
        return df.withColumn(SLICE, F.lit(0).cast("long")), False
    return sliced(df, part, order, by_bytes), True


def same_keys(left: DataFrame, right: DataFrame, names: list[str], prefix: str) -> Column:
    """Null-safe equality of ``left[name]`` and ``right[prefix + name]``."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[prefix + n]) for n in names], F.lit(True))


def running(
    df: DataFrame,
    part: list[str],
    order: list[str | Column],
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    previous: dict[str, Column] | None = None,
) -> DataFrame:
    """Add running values in the order of each group.

    ``sums``: inclusive running sum (null counts as 0).  ``lasts``: the latest non-null value so far.
    ``previous``: the value on the preceding row of the group.
    """
    frame, split = with_slices(df, part, order)
    return run_over(frame, part, order, split, sums, lasts, previous).drop(SLICE)


def run_over(
    frame: DataFrame,
    part: list[str],
    order: list[str | Column],
    split: bool,
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    previous: dict[str, Column] | None = None,
) -> DataFrame:
    """``running`` over the result of ``with_slices``; keeps ``_slice``."""
    sums, lasts, previous = sums or {}, lasts or {}, previous or {}
    keys = part + [SLICE] if split else part
    rows = Window.partitionBy(*keys).orderBy(*order)
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = frame.select(
        "*",
        *[F.sum(F.coalesce(e, F.lit(0))).over(so_far).alias(n) for n, e in sums.items()],
        *[F.last(e, ignorenulls=True).over(so_far).alias(n) for n, e in lasts.items()],
        *[F.lag(e).over(rows).alias(n) for n, e in previous.items()],
        *([F.row_number().over(rows).alias("_pos")] if previous and split else []),
    )
    if not split:
        return local

    # What each slice adds, then what precedes it in its group.  Rows: at most slices + groups.
    shift = [*part, SLICE]
    last_row = first_rows(frame, shift, _reverse(order)) if previous else None
    edge = frame.groupBy(*shift).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.coalesce(e, F.lit(0))).alias(n) for n, e in sums.items()],
        *[F.max_by(e, F.when(e.isNotNull(), _position(order))).alias(n) for n, e in lasts.items()],
    )
    if previous:
        ends = last_row.select(*[F.col(k).alias("_l_" + k) for k in shift], *[e.alias(n) for n, e in previous.items()])
        edge = edge.join(ends, same_keys(edge, ends, shift, "_l_")).select(edge["*"], *previous)
    w = Window.partitionBy(*part).orderBy(SLICE)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.select(
        *[F.col(k).alias("_e_" + k) for k in shift],
        F.sum("_n").over(before).alias("_earlier"),
        *[F.sum(n).over(before).alias("_e_" + n) for n in sums],
        *[F.last(n, ignorenulls=True).over(before).alias("_e_" + n) for n in lasts],
        *[F.lag(n).over(w).alias("_e_" + n) for n in previous],
    ).where("_earlier IS NOT NULL")

    joined = local.join(F.broadcast(edge), same_keys(local, edge, shift, "_e_"), "left")
    return joined.select(
        *frame.columns,
        *[(F.col(n) + F.coalesce("_e_" + n, F.lit(0))).alias(n) for n in sums],
        *[F.coalesce(n, "_e_" + n).alias(n) for n in lasts],
        *[F.when(F.col("_pos") == 1, F.col("_e_" + n)).otherwise(F.col(n)).alias(n) for n in previous],
    )


def _position(order: list[str | Column]) -> Column:
    names = [o for o in order if isinstance(o, str)]
    if len(names) < len(order):
        raise ValueError("the latest non-null value needs plain ascending order columns")
    return F.struct(*names)


def _reverse(order: list[str | Column]) -> list[Column]:
    _position(order)
    return [F.col(o).desc() for o in order]


def row_index(df: DataFrame, part: list[str], order: list[str | Column], out: str = "idx") -> DataFrame:
    """Add the 0-based position of each row in its group."""
    numbered = running(df, part, order, sums={out: F.lit(1).cast("long")})
    return numbered.withColumn(out, F.col(out) - 1)


def start_offset(df: DataFrame, part: list[str], order: list[str | Column], length: Column, out: str = "offset") -> DataFrame:
    """Add the sum of the lengths of the earlier rows of the group."""
    total = running(df, part, order, sums={out: length})
    return total.withColumn(out, F.col(out) - F.coalesce(length, F.lit(0)))


def truncate_to(
    df: DataFrame, part: list[str], order: list[str | Column], length: Column, total: Column
) -> DataFrame:
    """The rows whose running length stays within the declared total of their group; a total of -1 keeps all."""
    marked = running(df, part, order, sums={"_len": length})
    return marked.where((total == -1) | (F.col("_len") <= total)).drop("_len")


def resume_page(
    df: DataFrame, part: list[str], order: list[str | Column], key: str, size: Column, cursors: DataFrame, limit: int,
    wanted: Column | None = None,
) -> DataFrame:
    """The next page of every group: rows after the last-seen key until their sizes reach ``limit``.

    The row that reaches the limit is part of the page.  ``cursors`` has the group columns and ``cursor``.  A
    group whose cursor is not among its rows, or that has none, starts at its first row.  ``wanted`` restricts the
    rows that are returned and counted, not the search for the cursor.
    """
    frame, split = with_slices(df, part, order)
    marks = cursors.select(*[F.col(p).alias("_c_" + p) for p in part], "cursor")
    if not split:
        # One sort serves the search for the cursor and the page; Spark broadcasts the cursors if it finds them small.
        met = frame.join(marks, same_keys(frame, marks, part, "_c_"), "left")
        rows = Window.partitionBy(*part).orderBy(*order)
        met = met.withColumn("_idx", F.row_number().over(rows))
        at = F.min(F.when(F.col(key) == F.col("cursor"), F.col("_idx"))).over(Window.partitionBy(*part))
        after = F.coalesce(F.col("_idx") > at, F.lit(True))
        counted = F.when(after if wanted is None else after & F.coalesce(wanted, F.lit(False)), F.coalesce(size, F.lit(0)))
        met = met.withColumn("_size", counted)
        so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return met.withColumn("_end", F.sum("_size").over(so_far)).where(F.col("_end") - F.col("_size") < limit).select(*df.columns)
    placed = run_over(frame, part, order, split, {"_idx": F.lit(1).cast("long")})
    renamed = small_side(marks, computed=True)
    match = same_keys(placed, renamed, part, "_c_") & (placed[key] == renamed["cursor"])
    found = placed.join(renamed, match).groupBy(*part).agg(F.min("_idx").alias("_at"))
    found = small_side(found.select(*[F.col(p).alias("_f_" + p) for p in part], "_at"), computed=True)
    rest = placed.join(found, same_keys(placed, found, part, "_f_"), "left")
    rest = rest.where(F.col("_idx") > F.coalesce("_at", F.lit(0))).select(*df.columns, "_idx", SLICE)
    if wanted is not None:
        rest = rest.where(wanted)
    paged = run_over(rest, part, ["_idx"], split, {"_end": size})
    return paged.where(F.col("_end") - size < limit).select(*df.columns)


def switch_state(df: DataFrame, entity: list[str], order: list[str], level: Column, high: float, low: float,
                 strict_low: bool = False, out: str = "state") -> DataFrame:
    """``off`` from a level at or above ``high`` until one at or below ``low`` (below, if ``strict_low``).

    Between the marks the earlier state holds; an entity starts ``on``.
    """
    if not high > low:
        raise ValueError("the high mark must be above the low mark")
    calm = level < low if strict_low else level <= low
    crossing = F.when(level >= high, "off").when(calm, "on")
    marked = running(df, entity, order, lasts={out: crossing})
    return marked.withColumn(out, F.coalesce(out, F.lit("on")))


def idle_sessions(df: DataFrame, entity: list[str], ts: str, ttl_seconds: int) -> DataFrame:
    """Sessions of each entity: a gap of more than the TTL since its previous row starts a new one."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    moments = df.groupBy(*entity, ts).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_us", micros)
    frame, split = with_slices(moments, entity, ["_us"], counted=df)
    gaps = run_over(frame, entity, ["_us"], split, previous={"_prev": F.col("_us")})
    new = F.when(F.col("_us") - F.col("_prev") > ttl_seconds * 1_000_000, 1).otherwise(0)
    numbered = run_over(gaps, entity, ["_us"], split, {"session": new.cast("long")})
    return numbered.groupBy(*entity, "session").agg(
        F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.sum("_rows").alias("n")
    )
