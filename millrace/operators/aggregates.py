"""Grouped results.

Built-in aggregates combine in the map task before the shuffle, so a hot key sends one row per map task.  Lists
of values do not shrink that way; they are cut in pages of bounded length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import tokens
from millrace.operators.ordered import first_rows, running
from millrace.session import ship_with_tasks

ship_with_tasks(__name__)


def count_by(df: DataFrame, key: str, value: str, out: str = "n") -> DataFrame:
    """Non-null values per key, ordered by key; null keys form a group."""
    return df.groupBy(key).agg(F.count(value).alias(out)).orderBy(key)


def word_count(df: DataFrame, col: str, word: str = "word", out: str = "n") -> DataFrame:
    """Occurrences of each word of a text column, ordered by word."""
    words = df.select(F.explode(tokens(F.col(col))).alias(word))
    return words.groupBy(word).agg(F.count(F.lit(1)).alias(out)).orderBy(word)


def combine_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Count, sum and mean per key."""
    return df.groupBy(key).agg(F.count(value).alias("n"), F.sum(value).alias("total")).withColumn(
        "mean", F.try_divide(F.col("total").cast("double"), F.col("n"))
    )


def collect_pages(df: DataFrame, key: list[str], value: str, page_rows: int = 10_000) -> DataFrame:
    """All values of each key in order, as rows (key, ``page``, ``values``) of at most ``page_rows`` values.

    A key with few values is one row, page 0.  Null values are kept, first.  Equal values are counted in the map task and
    travel as one run; a run is cut where pages end, so equal values fill as many pages as they need.
    """
    runs = df.groupBy(*key, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running(runs, key, [value], sums={"_end": F.col("_n")}).withColumn("_start", F.col("_end") - F.col("_n"))
    size = F.lit(page_rows).cast("long")
    pages = F.sequence(F.floor(F.col("_start") / size), F.floor((F.col("_end") - 1) / size))
    cut = placed.withColumn("page", F.explode(pages))
    from_, to = F.greatest("_start", F.col("page") * size), F.least("_end", (F.col("page") + 1) * size)
    cut = cut.select(*key, "page", F.struct(from_.alias("at"), F.col(value).alias("value"), (to - from_).cast("int").alias("n")).alias("_run"))
    boxed = F.transform(F.array_sort(F.collect_list("_run")), lambda r: F.array_repeat(r["value"], r["n"]))
    return cut.groupBy(*key, "page").agg(F.flatten(boxed).alias("values"))


def group_by_key(df: DataFrame, key: str, value: str, page_rows: int = 10_000) -> DataFrame:
    return collect_pages(df, [key], value, page_rows)


def combine_runs(
    df: DataFrame, key: str, schema: str, combine: Callable[[pd.DataFrame], pd.DataFrame], held_keys: int = 100_000
) -> DataFrame:
    """Apply a combiner to runs of rows before the shuffle and to what arrives after it.

    ``combine`` takes rows in ``schema`` and returns rows in ``schema``, one per key (null keys too); how often it runs
    must not matter.  It gets Arrow batches that hold many keys.  A map task holds about ``held_keys`` combined rows and
    sends them on when there are more; after the shuffle rows come sorted by key and only the open key is held.  It
    is for combiners that built-in aggregates cannot express; those need no such help.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows wait until they are as many as the combined ones, so a combined row is not combined anew for every batch.
        held, waiting, rows = None, [], 0
        for batch in batches:
            waiting.append(batch)
            rows += len(batch)
            if held is None or rows >= min(len(held), held_keys):
                held = combine(pd.concat([*([] if held is None else [held]), *waiting], ignore_index=True))
                waiting, rows = [], 0
                if len(held) > held_keys:
                    yield held
                    held = None
        if waiting:
            held = combine(pd.concat([*([] if held is None else [held]), *waiting], ignore_index=True))
        if held is not None and len(held):
            yield held

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            rows = combine(batch if held is None else pd.concat([held, batch], ignore_index=True))
            last = batch[key].iloc[-1]
            open_key = rows[key].isna() if pd.isna(last) else rows[key] == last
            yield rows[~open_key]
            held = rows[open_key]
        if held is not None:
            yield held

    combined = df.mapInPandas(partial, schema)
    return combined.repartition(key).sortWithinPartitions(key).mapInPandas(final, schema)


def distinct_ids(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def count_ids(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    return df.select(col).distinct().agg(F.count(col).alias(out))


def count_dense_ids(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """Number of distinct ids, for non-negative ids that fill their range well.

    Map tasks combine ids to bitmaps of 32768 neighbours each; repeats cost nothing and nothing is shuffled per id.
    """
    ids = df.where(F.col(col).isNotNull()).groupBy(F.bitmap_bucket_number(F.col(col)).alias("_bucket"))
    bitmaps = ids.agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(col))).alias("_bits"))
    return bitmaps.agg(F.coalesce(F.sum(F.bitmap_count("_bits")), F.lit(0)).alias(out))


def ids_by_group(df: DataFrame, group: str, value: str, start: int, end: int) -> DataFrame:
    """Distinct ids of every group in [start, end), one row each; a group without ids has one row with a null id."""
    spine = df.sparkSession.range(start, end).select(F.col("id").cast(df.schema[group].dataType).alias(group))
    inside = df.where((F.col(group) >= start) & (F.col(group) < end) & F.col(value).isNotNull())
    ids = inside.select(group, value).distinct()
    # Only the names of groups meet; the ids of a large group stay where they are.
    without = spine.join(inside.select(group).distinct(), group, "left_anti")
    return ids.unionByName(without.withColumn(value, F.lit(None).cast(df.schema[value].dataType)))


def shard_ids(df: DataFrame, group: str, value: str, shards: int) -> DataFrame:
    """Distinct (group, id) with the shard ``group mod shards`` that stores them."""
    return df.select(F.pmod(F.col(group), F.lit(shards)).alias("shard"), group, value).distinct()


def ids_of_groups(sharded: DataFrame, group: str, value: str, wanted: DataFrame, shards: int) -> DataFrame:
    """Ids of the wanted groups read back from their shards; other groups of a shard are left out."""
    places = wanted.select(F.pmod(F.col(group), F.lit(shards)).alias("shard"), group).distinct()
    return sharded.join(places, ["shard", group], "left_semi").select(group, value)


def invert(df: DataFrame, key: str, sources: str) -> DataFrame:
    """From key -> list of sources to one row per distinct (source, key)."""
    return df.select(F.explode(sources).alias("source"), key).distinct()


def group_sizes(df: DataFrame, group: str, size: Column) -> DataFrame:
    """Total size and rows per group, and for all groups in the row whose ``is_total`` is 1."""
    return df.rollup(group).agg(
        F.sum(size).alias("total"), F.count(F.lit(1)).alias("n"), F.grouping(group).cast("int").alias("is_total")
    )


def huge_groups(df: DataFrame, owner: str, group: str, size: Column, threshold: int) -> DataFrame:
    """Groups of an owner whose total size is over the threshold."""
    totals = df.groupBy(owner, group).agg(F.sum(size).alias("total"))
    return totals.where(F.col("total") > threshold)


def huge_group_counts(huge: DataFrame, owner: str) -> DataFrame:
    """How many huge groups there are and how many owners have one."""
    per_owner = huge.groupBy(owner).agg(F.count(F.lit(1)).alias("_n"))
    return per_owner.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("groups"), F.count(F.lit(1)).alias("owners"))


def check_quorum(n: int, w: int, r: int) -> None:
    if n < 1 or w > n or r > n:
        raise ValueError("reads and writes cannot ask for more copies than there are")
    if w + r <= n:
        raise ValueError("a read quorum and a write quorum must share a copy: w + r > n")


def quorum(df: DataFrame, key: str, replica: str, ok: Column, n: int, w: int, r: int) -> DataFrame:
    """Per id the number of replicas with a successful write and whether there are at least ``w``.

    A replica written twice counts once.
    """
    check_quorum(n, w, r)
    # An id has few replicas, so the sets stay small; they are united in the map task and need one exchange.
    counted = df.groupBy(key).agg(F.size(F.collect_set(F.when(ok, F.col(replica)))).cast("long").alias("successes"))
    return counted.withColumn("good", F.col("successes") >= w)


def quorum_read(df: DataFrame, group: str, source: str, value: str, r: int) -> tuple[DataFrame, DataFrame]:
    """Distinct ids of each group over its first ``r`` sources, and the groups that have fewer sources."""
    answering = df.select(group, source).distinct()
    first = first_rows(answering, [group], [source], r)
    # At most r rows of a group are left to count.
    first = first.withColumn("answers", F.count(F.lit(1)).over(Window.partitionBy(group)))
    enough = first.where(F.col("answers") >= r).select(group, source)
    ids = df.join(enough, [group, source], "left_semi").select(group, value).distinct()
    return ids, first.where(F.col("answers") < r).select(group, "answers").distinct()


def size_bands(df: DataFrame, size: Column, cost: Column, l1: int, l2: int, l3: int, slow: int) -> DataFrame:
    """Rows per size band 1 (below ``l1``) to 4, and how many of them cost more than ``slow``."""
    band = F.when(size < l1, 1).when(size < l2, 2).when(size < l3, 3).otherwise(4)
    return df.groupBy(band.alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(cost > slow, 1).otherwise(0)).alias("slow")
    )


def read_stats(df: DataFrame, tier: str, used: Column, length: Column, raw_length: Column) -> DataFrame:
    """Per tier: rows, bytes and uncompressed bytes that were read and that were skipped."""
    unused = ~F.coalesce(used, F.lit(False))
    measures = {"rows": F.lit(1), "bytes": length, "raw_bytes": raw_length}
    return df.groupBy(tier).agg(
        *[F.coalesce(F.sum(F.when(used, m)), F.lit(0)).alias(f"read_{n}") for n, m in measures.items()],
        *[F.coalesce(F.sum(F.when(unused, m)), F.lit(0)).alias(f"skipped_{n}") for n, m in measures.items()],
    )


def health(
    df: DataFrame, owner: str | None, healthy: Column, used: Column, total: Column, minimum: float,
    corrupt: Column | None = None,
) -> DataFrame:
    """Whether at least ``minimum`` percent of the members are healthy, with space totals.

    A corrupt member counts as one that is not healthy, and its space does not count.  Without members there is
    nothing healthy.
    """
    usable = ~F.coalesce(corrupt, F.lit(False)) if corrupt is not None else F.lit(True)

    def total_of(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(usable, value)), F.lit(0))

    out = df.groupBy(*([owner] if owner else [])).agg(
        F.count(F.lit(1)).alias("members"), total_of(F.when(healthy, 1).otherwise(0)).alias("good"),
        F.sum(F.when(usable, 0).otherwise(1)).alias("corrupt"), total_of(used).alias("used"), total_of(total).alias("space"),
    )
    out = out.withColumn("corrupt", F.coalesce("corrupt", F.lit(0)))
    share = F.try_divide(F.col("good") * F.lit(100.0), F.col("members"))
    return out.withColumn("healthy", F.coalesce(share >= minimum, F.lit(False)))


def per_owner(df: DataFrame, owner: str, entity: str) -> DataFrame:
    """Distinct entities of each owner."""
    return df.select(owner, entity).distinct().groupBy(owner).agg(F.count(entity).alias("n"))


def commit_complete(df: DataFrame, group: str, member: str, expected: int) -> DataFrame:
    """Per group how many distinct members reported, and whether that is the expected number."""
    reported = df.select(group, member).distinct().groupBy(group).agg(F.count(member).alias("reported"))
    return reported.withColumn("complete", F.col("reported") == expected)
