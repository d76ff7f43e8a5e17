"""One or few rows per key: attempts, replicas, tiers, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import hash_slot
from millrace.operators.ordered import first_rows, row_index, running
from millrace.session import persist_table
from millrace.sizing import biggest_group, group_row_limit, small_side


def dedupe(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in order."""
    return first_rows(df, key, order)


def pick_attempt(
    events: DataFrame, task: str, attempt: str, order: str, success: Column, obsolete: Column, tasks: int | None = None,
    failed_tasks: int = 0,
) -> DataFrame:
    """The first attempt of each task that succeeded and was never made obsolete.

    With ``tasks`` the pick must be complete: a task number outside [0, tasks) fails the query, and so does a
    number of picked tasks other than ``tasks - failed_tasks``.
    """
    gone = events.where(obsolete).select(attempt).distinct()
    ok = events.where(success).select(task, attempt, order).join(gone, attempt, "left_anti")
    picked = first_rows(ok, [task], [order, attempt]).select(task, attempt)
    if tasks is None:
        return picked
    bad = F.when((F.col(task) < 0) | (F.col(task) >= tasks), 1).otherwise(0)
    tally = picked.agg(F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum(bad), F.lit(0)).alias("_bad"))
    wrong = (F.col("_n") + failed_tasks != tasks) | (F.col("_bad") > 0)
    text = F.concat(F.lit(f"expected {tasks} tasks, picked "), F.col("_n").cast("string"),
                    F.lit(", out of range "), F.col("_bad").cast("string"))
    checked = tally.select(F.when(wrong, F.raise_error(text).cast("boolean")).otherwise(True).alias("_fine"))
    # The tally is one row.
    return picked.join(F.broadcast(checked), F.col("_fine")).drop("_fine")


def first_good(df: DataFrame, key: str, replica: str, ok: Column, order: list[str]) -> DataFrame:
    """Per id the first replica whose checksum matches."""
    return first_rows(df.where(ok), [key], [replica, *order])


def without_good(df: DataFrame, key: str, replica: str, ok: Column) -> DataFrame:
    """Ids no replica of which is good, with the number of replicas tried."""
    tried = df.select(key, replica, F.coalesce(ok, F.lit(False)).alias("_ok")).groupBy(key, replica)
    seen = tried.agg(F.max("_ok").alias("_ok"))
    per_id = seen.groupBy(key).agg(F.count(F.lit(1)).alias("replicas"), F.max("_ok").alias("_ok"))
    return per_id.where(~F.col("_ok")).select(key, "replicas")


def coalesce_tiers(df: DataFrame, key: list[str], tier_rank: Column, order: list[str]) -> DataFrame:
    """Per id the copy from the nearest tier."""
    return first_rows(df, key, [tier_rank, *order])


def budget_pick(df: DataFrame, key: str, size: str, high: int, low: int, threshold: int) -> DataFrame:
    """Largest first until over ``high - low`` bytes are picked.

    Once more than half of that is picked, only rows over the threshold are.  The picked rows are a prefix of the
    size order, so one running sum decides.
    """
    budget = high - low
    ranked = running(df, [], [F.col(size).desc(), F.col(key)], sums={"_upto": F.col(size)})
    before = F.col("_upto") - F.col(size)
    return ranked.where((before <= budget) & ((F.col(size) > threshold) | (before <= budget // 2))).drop("_upto")


def diverse_topk(df: DataFrame, k: int, host: str, order: list[str | Column], mode: str = "must") -> DataFrame:
    """``k`` rows in rank order, spread over hosts; adds ``pos``.

    ``must``: the best row of each host only, so there may be fewer than ``k``.  ``prefer``: those first, then the
    others in rank order until there are ``k``.  ``none``: the first ``k``.
    """
    if mode not in ("must", "prefer", "none"):
        raise ValueError(mode)
    if mode == "none":
        ranked = df.orderBy(*order).limit(k).withColumn("_later", F.lit(0))
    else:
        per_host = first_rows(df, [host], order, k + 1 if mode == "prefer" else 1, "_rank")
        later = F.when(F.col("_rank") > 1, 1).otherwise(0)
        ranked = per_host.withColumn("_later", later).orderBy("_later", *order).limit(k).drop("_rank")
    # At most k rows are left to number.
    numbered = F.row_number().over(Window.orderBy("_later", *order)) - 1
    return ranked.withColumn("pos", numbered.cast("int")).drop("_later")


def rank_load(
    df: DataFrame, available: Column, assigned: Column, partitions: int, replica: int, max_nodes: int, tie: list[str],
    out: str = "pos",
) -> DataFrame:
    """Position by available space per assigned and planned partition, most first."""
    planned = max(partitions * replica // max_nodes, 1)
    score = available.cast("double") / (assigned + F.lit(planned))
    scored = df.withColumn("_score", score)
    return row_index(scored, [], [F.col("_score").desc(), *[F.col(t) for t in tie]], out).drop("_score")


def rank_cost(df: DataFrame, cost: Column, healthy: Column, load: Column, tie: list[str], out: str = "pos") -> DataFrame:
    """Position by cost, then load; unhealthy rows cost the most."""
    most = F.lit((1 << 63) - 1)
    priced = df.withColumn("_cost", F.when(healthy, cost.cast("long")).otherwise(most)).withColumn("_load", load)
    return row_index(priced, [], ["_cost", "_load", *tie], out).drop("_cost", "_load")


def pick_target(entities: DataFrame, targets: DataFrame, existing: DataFrame, entity: str, target: str,
                healthy: Column, load: Column) -> DataFrame:
    """A target for every entity: the one it has, else the least loaded healthy one.

    If no target is healthy the least loaded of all is taken.
    """
    best = targets.orderBy(F.when(healthy, 0).otherwise(1), load, target).limit(1)
    best = best.select(F.col(target).alias("_best"))
    held = existing.select(entity, F.col(target).alias("_held"))
    # One row at most goes to all tasks.
    return entities.select(entity).join(held, entity, "left").join(F.broadcast(best), F.lit(True), "left").select(
        entity, F.coalesce("_held", "_best").alias(target)
    )


def prefer_healthy(df: DataFrame, item: str, order: list[str], bad: Column, k: int, total: int) -> DataFrame:
    """Sources of each item in two rounds: ``k`` with the healthy ones first, then ``total - k`` of the remaining ones
    in their own order.  Adds ``round``.

    Only the first ``k`` by health and the first ``total`` by order can be chosen; if an item has too many sources for
    one task, each map task sends no more than those.  Repeated rows count each.
    """
    flagged = df.withColumn("_bad", F.coalesce(bad, F.lit(False)).cast("int"))
    if biggest_group(df, [item]) <= group_row_limit(df.sparkSession):
        w = Window.partitionBy(item)
        ranked = flagged.withColumn("_first", F.row_number().over(w.orderBy("_bad", *order)))
        ranked = ranked.withColumn("round", F.when(F.col("_first") <= k, 1).otherwise(2))
        ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy(item, "round").orderBy(*order)))
        kept = ranked.where((F.col("round") == 1) | (F.col("_rank") <= total - k))
        return kept.drop("_bad", "_first", "_rank")
    # Each row gets an identity, so that repeated rows stay apart; written, so that both selections see the same one.
    flagged = persist_table(flagged.withColumn("_id", F.monotonically_increasing_id()), "sources")
    primary = first_rows(flagged, [item], ["_bad", *order, "_id"], k, "_first")
    others = first_rows(flagged, [item], [*order, "_id"], total, "_any")
    both = primary.select(*flagged.columns, "_first").unionByName(
        others.select(*flagged.columns).withColumn("_first", F.lit(None).cast("int"))
    )
    merged = both.groupBy(*flagged.columns).agg(F.max("_first").alias("_first"))
    first = merged.where(F.col("_first").isNotNull()).withColumn("round", F.lit(1))
    rest = first_rows(merged.where(F.col("_first").isNull()), [item], order, total - k) if total > k else merged.limit(0)
    return first.unionByName(rest.withColumn("round", F.lit(2))).drop("_first", "_bad", "_id")


def place(entities: DataFrame, existing: DataFrame, targets: DataFrame, entity: str, target: str, ok: Column) -> DataFrame:
    """Keep an entity's target while it is writable, else hash it over the writable ones; null if there are none.

    ``targets`` are the places of one system; a count bounds them before their list goes to all tasks.
    """
    writable = targets.where(ok).select(target).distinct()
    ranked = small_side(row_index(writable, [], [target], "_at"))
    size = writable.agg(F.count(F.lit(1)).alias("_size"))
    held = existing.select(entity, F.col(target).alias("_held")).join(
        small_side(writable.select(F.col(target).alias("_ok"))), F.col("_held") == F.col("_ok"), "left_semi"
    )
    out = entities.select(entity).join(held, entity, "left").join(F.broadcast(size), F.lit(True), "left")
    slot = F.when(F.col("_size") > 0, hash_slot(F.col(entity), F.col("_size")))
    out = out.withColumn("_slot", slot)
    out = out.join(ranked, F.col("_slot") == F.col("_at"), "left")
    return out.select(entity, F.coalesce("_held", target).alias(target))
