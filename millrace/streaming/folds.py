"""Streams whose state is a table folded over the micro-batches (see ``run.fold_batches``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.aggregates import per_owner
from millrace.operators.chunking import chunk
from millrace.operators.ordered import SLICE, first_rows, run_over, same_keys, with_slices
from millrace.operators.project import allow, deny
from millrace.session import persist_table
from millrace.sizing import small_side
from millrace.streaming.keyed import quota_run, retry_run
from millrace.streaming.run import _path, fold_batches

# Fixed value: entities an owner may have unless told otherwise.
DEFAULT_QUOTA = 5


def _quota_lines(lines: DataFrame) -> DataFrame:
    parts = F.split(F.regexp_replace("value", r"^\s*#.*$", ""), "=")
    number = F.when(F.size(parts) == 2, F.trim(parts[1])).try_cast("int")
    return lines.select(F.trim(parts[0]).alias("owner"), number.alias("quota")).where("quota is not null and owner != ''")


def read_quotas(spark: SparkSession, path: str) -> DataFrame:
    """``owner = n`` lines as (owner, quota); blank lines, ``#`` lines and lines that are no such pair are ignored."""
    return _quota_lines(spark.read.text(path))


def follow_quotas(spark: SparkSession, folder: str) -> DataFrame:
    """The quota lines of each file that appears in a folder, as a stream of changes for ``quota``."""
    return _quota_lines(spark.readStream.schema("value string").option("recursiveFileLookup", "true").text(folder))


def quota_admit(
    df: DataFrame, owner: str, entity: str, ts: str, overrides: DataFrame, default: int = DEFAULT_QUOTA,
    live: DataFrame | None = None,
) -> DataFrame:
    """Whether each entity is admitted: it is live, or it is among the first new ones its owner has room for.

    ``overrides`` has owner and ``quota``; ``live`` owner and entity.  No owner admits more than the largest quota,
    so each map task sends at most that many new entities per owner.
    """
    seen = df.groupBy(owner, entity).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))
    seen = seen.withColumn("_live", F.lit(False))
    if live is not None:
        held = live.select(owner, entity, F.lit(True).alias("_held"))
        seen = seen.join(held, [owner, entity], "left").withColumn("_live", F.coalesce("_held", F.lit(False))).drop("_held")
    most = max(default, overrides.agg(F.max("quota")).first()[0] or 0)
    ranked = first_rows(seen.where(~F.col("_live")), [owner], ["first_seen", entity], most, "_rank")
    room = F.coalesce("quota", F.lit(default))
    ranked = ranked.join(small_side(overrides.select(owner, "quota")), owner, "left")
    if live is not None:
        ranked = ranked.join(per_owner(live, owner, entity).withColumnRenamed("n", "_n"), owner, "left")
        room = room - F.coalesce("_n", F.lit(0))
    new = ranked.where(F.col("_rank") <= room).select(owner, entity, F.lit(True).alias("_new"))
    out = seen.join(new, [owner, entity], "left")
    return out.select(
        owner, entity, "first_seen", "last_seen", (F.col("_live") | F.coalesce("_new", F.lit(False))).alias("admitted")
    )


def quota(
    stream: DataFrame, owner: str, entity: str, ts: str, overrides: DataFrame, default: int = DEFAULT_QUOTA,
    ttl_seconds: int | None = None, delay: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Admission verdicts per micro-batch and the live entities at the end.

    ``overrides`` (owner, ``quota``) is a table, or a stream of changes: a line for an owner holds until the next one, and
    a null quota brings the default back.  An entity idle for more than the TTL before its owner's first row of a batch
    frees its place before that batch.  With ``delay`` a timer also frees it once the watermark, which is that much behind
    the newest row, has passed; rows older than the watermark are then not judged.  State is kept per owner: a
    micro-batch reads and writes the owners it meets.
    """
    return quota_run(stream, owner, entity, ts, overrides, default, ttl_seconds, delay)[1:]


def counter_state(batch: DataFrame, state: DataFrame, parent: str, group: str, attempt: str) -> DataFrame:
    """Failures per (parent, attempt, group) so far, for the newest attempt of each parent and later ones seen."""
    counted = batch.groupBy(parent, group, attempt).agg(F.count(F.lit(1)).alias("failures"))
    newest = state.groupBy(parent).agg(F.max(attempt).alias("_newest"))
    merged = counted.unionByName(state).groupBy(parent, group, attempt).agg(F.sum("failures").alias("failures"))
    joined = merged.join(newest, parent, "left")
    return joined.where(F.col("_newest").isNull() | (F.col(attempt) >= F.col("_newest"))).drop("_newest")


def retry_counter(stream: DataFrame, parent: str, group: str, attempt: str, maximum: int) -> tuple[DataFrame, DataFrame]:
    """Rows (parent, group, attempt, failures) at the batch where a group reaches ``maximum``, and the final counters.

    A newer attempt of the parent resets all its groups; reports of older attempts are ignored.  Attempts of a
    parent are taken to arrive in order inside a micro-batch.  State is kept per parent.
    """
    return retry_run(stream, parent, group, attempt, maximum)[1:]


def size_batches(
    stream: DataFrame, group: str, order: str, size: str, limit: int, flush: bool = True
) -> DataFrame:
    """Batches of a group's rows, each closed by the row that brings it to ``limit``; the rest is emitted at the end.

    A batch of very many rows comes in several rows, pages of its members, whose totals add up.

    ``order`` identifies a row and grows from one micro-batch to the next.  State: the rows of each group's open
    batch, which are fewer than the limit allows.
    """
    fields = {n: stream.schema[n].dataType.simpleString() for n in (group, order, size)}
    state_ddl = ", ".join(f"`{n}` {k}" for n, k in fields.items())
    out_ddl = f"`{group}` {fields[group]}, total long, n long, members array<{fields[order]}>"
    columns = [group, "total", "n", "members"]

    def step(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = persist_table(batch.select(group, order, size).unionByName(state), "pending")
        chunks = persist_table(chunk(rows, [group], [order], F.col(size), limit, order), "batches")
        # A batch may come in several pages of members.
        ends = chunks.groupBy(group, "offset").agg(F.max(F.col("at") + F.col("total")).alias("_end")).where(F.col("_end") - F.col("offset") >= limit)
        done = small_side(ends.groupBy(F.col(group).alias("_d_" + group)).agg(F.max("_end").alias("_done")), computed=True)
        closed = chunks.join(done, same_keys(chunks, done, [group], "_d_")).where(F.col("offset") < F.col("_done")).select(*chunks.columns)
        frame, split = with_slices(rows, [group], [order])  # rows is a table by now
        ends = run_over(frame, [group], [order], split, {"_end": F.col(size).cast("long")}).drop(SLICE)
        open_rows = ends.join(done, same_keys(ends, done, [group], "_d_"), "left").where(
            F.col("_done").isNull() | (F.col("_end") - F.col(size) >= F.col("_done"))
        )
        return closed, open_rows.select(group, order, size)

    closed, left = fold_batches(stream, step, out_ddl, state_ddl, "size-batches")
    if not flush:
        return closed
    rest = chunk(left, [group], [order], F.col(size), limit, order)
    return closed.select(*columns).unionByName(rest.select(*columns))


def with_list(stream: DataFrame, col: str, path: str, mode: str) -> DataFrame:
    """Filter each micro-batch by a list file read anew for it.

    ``allow``: an empty or missing file leaves the earlier list in force.  ``deny``: a missing file clears the list.
    """
    if mode not in ("allow", "deny"):
        raise ValueError(mode)

    def read(spark: SparkSession, state: DataFrame) -> DataFrame:
        where, system = _path(spark, path)
        found = spark.read.text(path).select(F.col("value").alias("entry")) if system.exists(where) else None
        if mode == "deny":
            return found if found is not None else state.limit(0)
        return state if found is None or found.where(F.trim("entry") != "").isEmpty() else found

    def step(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        entries = read(batch.sparkSession, state)
        keep = allow if mode == "allow" else deny
        return keep(batch, col, entries), entries

    return fold_batches(stream, step, stream.schema, "entry string", f"list-{mode}")[0]
