"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import tokens
from millrace.operators.ordered import first_rows
from millrace.sizing import key_set, small_side


def rewrite_key(df: DataFrame, out: str, cases: list[tuple[Column, Column]], default: Column) -> DataFrame:
    """Add ``out`` = value of the first case whose condition holds, else the default."""
    (first, value), *rest = cases
    expr = F.when(first, value)
    for condition, value in rest:
        expr = expr.when(condition, value)
    return df.withColumn(out, expr.otherwise(default))


def explode_tokens(df: DataFrame, col: str, out: str = "token") -> DataFrame:
    """One row per word of a text column; see ``functions.text.tokens`` for the rule."""
    return df.select(*[c for c in df.columns if c != col], F.explode(tokens(F.col(col))).alias(out))


def required(
    df: DataFrame, expected: DataFrame, accepted: DataFrame, key: str, attempt: str, order: list[str]
) -> DataFrame:
    """The first row of every expected key that an accepted attempt produced.

    ``expected`` has the column ``key``, ``accepted`` the column ``attempt``.  The filters run before the
    de-duplication; the key is the unit that is de-duplicated.
    """
    kept = df.join(small_side(accepted.select(attempt).distinct(), computed=True), attempt, "left_semi")
    kept = kept.join(key_set(expected, [key]), key, "left_semi")
    return first_rows(kept, [key], order).select(*df.columns)


def between_parts(df: DataFrame, part: str, start: int, end: int) -> DataFrame:
    """Rows whose partition number is in [start, end)."""
    return df.where((F.col(part) >= start) & (F.col(part) < end))


def slice_attempts(df: DataFrame, attempt: str, ids: DataFrame) -> DataFrame:
    """Rows written by one of the attempts in ``ids`` (one column of the same name)."""
    return df.join(small_side(ids.select(attempt).distinct(), computed=True), attempt, "left_semi")


def has_all(df: DataFrame, tags: str, needed: list[str]) -> DataFrame:
    """Rows whose array column holds every needed tag."""
    wanted = F.array(*[F.lit(t) for t in needed]).cast("array<string>")
    return df.where(F.size(F.array_except(wanted, F.col(tags))) == 0)


def allow(df: DataFrame, col: str, listed: DataFrame) -> DataFrame:
    """Rows whose trimmed id is in the one-column list; list entries are trimmed and blanks ignored."""
    entries = listed.select(F.trim(F.col(listed.columns[0])).alias("_entry")).where("_entry <> ''").distinct()
    return df.join(small_side(entries, computed=True), F.trim(df[col]) == F.col("_entry"), "left_semi")


def deny(df: DataFrame, col: str, listed: DataFrame) -> DataFrame:
    """Rows whose id is not in the list; entries are trimmed, blank lines and ``#`` lines are ignored."""
    entries = listed.select(F.trim(F.col(listed.columns[0])).alias("_entry"))
    entries = entries.where((F.col("_entry") != "") & ~F.col("_entry").startswith("#")).distinct()
    return df.join(small_side(entries, computed=True), df[col] == F.col("_entry"), "left_anti")


def by_status(df: DataFrame, entity: str, status: str, wanted: str | None = None) -> DataFrame:
    """Entities with the wanted status (all when none is given), ordered by id."""
    chosen = df if wanted is None else df.where(F.col(status) == wanted)
    return chosen.orderBy(entity)


def pct_at_least(df: DataFrame, available: Column, total: Column, threshold: float) -> DataFrame:
    """Rows where available is at least ``threshold`` percent of total."""
    return df.where(F.try_divide(available.cast("double"), total.cast("double") / F.lit(100.0)) >= threshold)
