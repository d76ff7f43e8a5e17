"""Greedy chunks of ordered rows: a chunk closes at the first row that brings it to a limit.

Where a chunk ends decides where the next begins, so running sums in a window cannot express it.  Each task reads the
sorted rows of its groups once, in Arrow batches; of the chunk that is open it holds the start, the size and one page of
members.  A group too large for one task is cut into slices (``ordered.sliced``) and stays exact: what a slice does to the
chunk that is open when it starts depends only on where that chunk began, and as a function of that start it is a step
function.  Every slice writes its steps as rows; the functions of neighbouring slices are composed in pairs, level by level,
which is a lookup of the left one's results among the right one's steps; going back down, each slice learns the chunk
that is open at its start, and then all slices are cut at once.

A row has a start ``a`` and an end ``b`` on a common axis; a chunk that began at ``a0`` closes at the first row
with ``b - a0 >= limit``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ordered import SLICE, run_over, running, same_keys, with_slices
from millrace.session import persist_table, ship_with_tasks

ship_with_tasks(__name__)

# "No chunk is open" where a chunk start is expected.
CLOSED = -(1 << 62)
# Members in one row of the result.
PAGE_ROWS = 10_000


class Cuts:
    """Closing rows of one sorted run.  No chunk reaches over two islands; ``island`` numbers them in order."""

    def __init__(self, a: np.ndarray, b: np.ndarray, island: np.ndarray, limit: int):
        self.a, self.b, self.limit = a, b, limit
        # One past the last row of each row's island.
        self.end = np.searchsorted(island, island, side="right")
        self.jump = None
        if len(b) and (b[1:] >= b[:-1]).all():
            close = np.searchsorted(b, a + limit)
            past = np.where(self.end < len(a), self.end, len(a) + 1)
            self.jump = np.where(close < self.end, close + 1, past).tolist()

    def next_start(self, i: int, opened: int | None = None) -> int:
        """First row after the chunk that holds row ``i``; past the row count if that chunk stays open.

        The chunk began at row ``i``, or before the run at ``opened``.
        """
        if opened is None and self.jump is not None:
            return self.jump[i]
        n, end = len(self.a), int(self.end[i])
        start = self.a[i] if opened is None else opened
        hits = np.flatnonzero(self.b[i:end] >= start + self.limit)
        if len(hits):
            return i + int(hits[0]) + 1
        return end if end < n else n + 1

    def steps(self, since: int) -> tuple[list[int], list[int]]:
        """The run as a step function ``(hi, out)``.

        A chunk open since ``s`` leaves the run with a chunk open since ``out[k]``, for the first ``k`` with
        ``s <= hi[k]``; above the last step it passes through still open.  ``since`` is where the first island
        began: a chunk begun before it ends before the run, like no open chunk at all, ``CLOSED``.
        """
        n, leaves = len(self.a), {len(self.a): CLOSED}

        def leaving(i: int) -> int:
            path = []
            while i not in leaves:
                path.append(i)
                i = self.next_start(i)
                if i > n:
                    leaves[path[-1]] = int(self.a[path[-1]])
                    i = path[-1]
            for p in path:
                leaves[p] = leaves[i]
            return leaves[i]

        fresh, end = leaving(0), int(self.end[0])
        top = np.maximum.accumulate(self.b[:end])
        need = min(int(np.searchsorted(top, self.a[0] + self.limit)) + 1, end)
        his = [since - 1, *(top[:need] - self.limit).tolist()]
        outs = [fresh, *[leaving(j + 1) for j in range(need)]]
        if end < n:
            his.append(int(self.a[0]))
            outs.append(leaving(end))
        return _merge_steps(his, outs)


class Scan:
    """Cuts sorted rows of any number of groups that come in batches; each row is looked at once."""

    def __init__(self, keys: list[str], limit: int, members: str | None, page_rows: int):
        self.keys, self.limit, self.members = keys, limit, members
        self.page_rows = page_rows if members else 1 << 62
        # The open chunk: its keys (a table of one row), island, start; its open page: start, rows, end, number of its first row, members.
        self.head: pa.Table | None = None
        self.since = self.start = self.at = self.paged = self.stop = self.first = 0
        self.held: list[pa.Array] = []

    def feed(self, rows: pa.Table) -> pa.Table:
        """The chunks (pages of chunks, if they have members) that end in these rows."""
        a, b, since, opened, seq = (rows[name].to_numpy() for name in ("_a", "_b", "_since", "_open", "_seq"))
        n = len(a)
        fresh = np.zeros(n, dtype=bool)
        fresh[1:] = since[1:] != since[:-1]
        for key in self.keys:
            codes = rows[key].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
            fresh[1:] |= codes[1:] != codes[:-1]
        follows = self.head is not None and since[0] == self.since and all(_same(self.head[k][0], rows[k][0]) for k in self.keys)
        island = np.cumsum(fresh)
        # Lay the islands out one after another on the axis.
        heads = np.flatnonzero(np.append(True, fresh[1:]))
        span = np.maximum.reduceat(b, heads) - a[heads]
        shift = (np.cumsum(span) - span - a[heads])[island]
        cuts = Cuts(a + shift, b + shift, island, self.limit)

        # Of each page that ends here: one past its last row, start of its chunk, its own start, stop, rows, first number.
        pages = [] if follows or self.head is None else [(0, self.start, self.at, self.stop, self.paged, self.first)]
        i, open_page = 0, None
        while i < n:
            if i == 0 and follows:
                start, at, paged, first = self.start, self.at, self.paged, self.first
                after = cuts.next_start(0, int(start + shift[0]))
            else:
                from_before = opened[i] != CLOSED and opened[i] >= since[i]
                start, at, paged, first = int(opened[i]) if from_before else int(a[i]), int(a[i]), 0, int(seq[i])
                after = cuts.next_start(i, int(start + shift[i]) if from_before else None)
            end, closed, begin = min(after, n), after <= n, i
            while end - begin + paged > self.page_rows:
                # The page is full; a chunk that has no size yet keeps its rows on one page.
                full = max(begin, begin + self.page_rows - paged)
                if (b[full - 1] if full else self.stop) <= start:
                    break
                pages.append((full, start, at, int(b[full - 1]) if full else self.stop, paged + full - begin, first))
                begin, at, paged, first = full, int(a[full]), 0, int(seq[full])
            if closed:
                pages.append((end, start, at, int(b[end - 1]), paged + end - begin, first))
            else:
                open_page = begin, start, at, paged + end - begin, first
            i = after
        out = self._out(rows, pages)
        if pages:
            self.held = []
        if open_page is None:
            self.head = None
        else:
            begin, self.start, self.at, self.paged, self.first = open_page
            self.head, self.since, self.stop = rows.select(self.keys).slice(n - 1), since[-1], int(b[-1])
            if self.members:
                self.held.append(rows[self.members].combine_chunks().slice(begin))
        return out

    def _out(self, rows: pa.Table, pages: list[tuple]) -> pa.Table:
        ends, starts, ats, stops, counts, firsts = ([p[k] for p in pages] for k in range(6))
        # The first page may be the open one, without a row of its own here.
        lone = bool(pages) and ends[0] == 0
        at_rows = pa.array([e - 1 for e in ends[lone:]], pa.int64())
        columns = {}
        for key in self.keys:
            taken = rows[key].take(at_rows).combine_chunks()
            columns[key] = pa.concat_arrays([self.head[key].combine_chunks(), taken]) if lone else taken
        for name, values in (("start", starts), ("at", ats), ("stop", stops), ("n", counts), ("first", firsts)):
            columns[name] = pa.array(values, pa.int64())
        if self.members:
            column = rows[self.members].combine_chunks()
            values = pa.concat_arrays([*self.held, column.slice(0, ends[-1] if pages else 0)]) if pages else column.slice(0, 0)
            offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
            columns["members"] = pa.ListArray.from_arrays(pa.array(offsets), values)
        return pa.table(columns)

    def finish(self, rows: pa.Table) -> pa.Table:
        """The chunk that is still open after the last rows (``rows`` is any table of their schema)."""
        return self._out(rows.slice(0, 0), [] if self.head is None else [(0, self.start, self.at, self.stop, self.paged, self.first)])


def _same(left: pa.Scalar, right: pa.Scalar) -> bool:
    """Equality as grouping has it: nulls are equal, and so are NaNs."""
    x, y = left.as_py(), right.as_py()
    return x == y or (x != x and y != y)


def _merge_steps(his: list[int], outs: list[int]) -> tuple[list[int], list[int]]:
    """Drop steps that never apply and join neighbours with the same result."""
    hi: list[int] = []
    out: list[int] = []
    for h, o in zip(his, outs):
        if hi and h <= hi[-1]:
            continue
        if out and out[-1] == o:
            hi[-1] = h
        else:
            hi.append(h)
            out.append(o)
    return hi, out


class Running:
    """Adds ``_seq`` (from 1) and the running sums ``_a`` and ``_b`` of ``_size`` to sorted rows that come in batches.

    Every run of equal keys begins at its ``_base_seq`` and ``_base``; only its first row keeps ``_open``.
    """

    def __init__(self, keys: list[str]):
        self.keys, self.seq, self.total = keys, 0, 0
        self.head: pa.Table | None = None

    def feed(self, rows: pa.Table) -> pa.Table:
        size, base, number, opened = (rows[name].to_numpy() for name in ("_size", "_base", "_base_seq", "_open"))
        n = len(size)
        fresh = np.zeros(n, dtype=bool)
        fresh[0] = self.head is None
        for key in self.keys:
            column = rows[key].combine_chunks()
            # Grouping takes -0.0 and 0.0 as equal.
            column = pc.add(column, pa.scalar(0.0, column.type)) if pa.types.is_floating(column.type) else column
            codes = column.dictionary_encode().indices.fill_null(-1).to_numpy()
            fresh[1:] |= codes[1:] != codes[:-1]
            fresh[0] = fresh[0] or not _same(self.head[key][0], column[0])
        heads = np.flatnonzero(fresh)
        run = np.cumsum(fresh)
        # What precedes each run of this batch; the first may have begun in an earlier one.
        before = np.append(self.total, base[heads])
        passed = np.cumsum(size)
        skipped = np.append(0, passed[heads] - size[heads])
        b = passed + (before - skipped)[run]
        # Whole numbers wrap and come back right unless a group's own sum is too large.
        about = np.cumsum(size, dtype=np.float64)
        about = about + (before.astype(np.float64) - np.append(0.0, about[heads] - size[heads]))[run]
        if np.abs(about).max() >= 2.0 ** 63:
            raise OverflowError("the sizes of a group add up to more than a long holds")
        seq = np.arange(n) - np.append(-1 - self.seq, heads - number[heads] - 1)[run]
        self.head, self.seq, self.total = rows.select(self.keys).slice(n - 1), int(seq[-1]), int(b[-1])
        columns = {name: rows[name] for name in rows.column_names if name not in ("_size", "_base", "_base_seq", "_open")}
        since, opened = np.zeros(n, np.int64), np.where(fresh, opened, CLOSED)
        return pa.table(columns | {name: pa.array(x) for name, x in (("_seq", seq), ("_a", b - size), ("_b", b), ("_since", since), ("_open", opened))})


def _fields(df: DataFrame, names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType, True) for n in names]


def _lookup(steps: DataFrame, probes: DataFrame, run: list[str]) -> DataFrame:
    """``probes`` (run, ``s``, ..) with ``to``: what the step function of their run (``hi``, ``out``) makes of ``s``.

    The step that applies is the first with ``s <= hi``; above the last one ``s`` stays.  Steps and probes are put into
    one order, so that runs of any length are spread over tasks like other running values.
    """
    rest = [c for c in probes.columns if c not in (*run, "s")]
    marks = steps.select(*run, (-F.col("hi")).alias("_down"), F.lit(0).alias("_kind"), "out", *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in rest])
    asked = probes.select(*run, (-F.col("s")).alias("_down"), F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("out"), *rest)
    known = running(marks.unionAll(asked), run, ["_down", "_kind"], lasts={"_to": F.col("out")})
    return known.where("_kind = 1").select(*run, (-F.col("_down")).alias("s"), *rest, F.coalesce("_to", -F.col("_down")).alias("to"))


def _shorter(steps: DataFrame, run: list[str]) -> DataFrame:
    """The same step functions without steps that have the result of the next higher one."""
    above = running(steps.withColumn("_down", -F.col("hi")), run, ["_down"], previous={"_above": F.col("out")})
    return above.where("_above is null or _above != out").select(*run, "hi", "out")


def _compose(steps: DataFrame, part: list[str]) -> DataFrame:
    """One level of the tree: runs 2k and 2k + 1 of a group become run k."""
    run = [*part, "_run"]
    paired = steps.withColumn("_pair", F.shiftright("_run", 1))
    left, right = paired.where("_run % 2 = 0"), paired.where("_run % 2 = 1")
    pair = [*part, "_pair"]
    through = _lookup(right.select(*pair, "hi", "out"), left.select(*pair, F.col("out").alias("s"), "hi"), pair)
    through = through.select(*pair, "hi", F.col("to").alias("out"))
    # Beyond the left one's last step a start meets the right one as it is.  One row per pair: fewer than slices.
    last = left.groupBy(*[F.col(c).alias("_l_" + c) for c in pair]).agg(F.max("hi").alias("_last"))
    beyond = right.join(F.broadcast(last), same_keys(right, last, pair, "_l_"), "left").where("_last is null or hi > _last").select(*pair, "hi", "out")
    return _shorter(through.unionAll(beyond).withColumnRenamed("_pair", "_run"), run)


def _open_at_slices(rows: DataFrame, part: list[str], limit: int) -> DataFrame:
    """For every slice of a group: the start of the chunk open there (``_open``, CLOSED if none)."""
    keys = _fields(rows, part)

    def slice_steps(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_seq")
        a, b, since = (pdf[c].to_numpy() for c in ("_a", "_b", "_since"))
        hi, out = Cuts(a, b, since, limit).steps(int(since[0]))
        head = pdf[part + ["_run"]].iloc[:1]
        return head.loc[head.index.repeat(len(hi))].reset_index(drop=True).assign(hi=hi, out=out)

    # Only groups that reach over several slices need it: fewer than there are slices.
    wide = rows.groupBy(*part).agg(F.min(SLICE).alias("_lo"), F.max(SLICE).alias("_hi")).where("_lo < _hi")
    wide = persist_table(wide.select(*[F.col(k).alias("_w_" + k) for k in part], "_lo", "_hi"), "wide")
    narrow = rows.select(*part, SLICE, "_seq", "_a", "_b", "_since")
    narrow = narrow.join(F.broadcast(wide), same_keys(narrow, wide, part, "_w_"))
    narrow = narrow.withColumn("_run", F.col(SLICE) - F.col("_lo")).select(*part, "_run", "_seq", "_a", "_b", "_since")
    steps = narrow.groupBy(*part, "_run").applyInPandas(
        slice_steps, T.StructType([*keys, *[T.StructField(c, T.LongType()) for c in ("_run", "hi", "out")]])
    )
    levels = [persist_table(steps, "steps")]
    most = wide.agg(F.max(F.col("_hi") - F.col("_lo") + 1)).first()[0] or 0
    while most > 2:
        levels.append(persist_table(_compose(levels[-1], part), "steps"))
        most = (most + 1) // 2

    names = [F.col("_w_" + k).alias(k) for k in part]
    starts = wide.select(*names, F.lit(0).cast("long").alias("_run"), F.lit(CLOSED).alias("s"))
    for steps in reversed(levels):
        # Fewer rows than slices; a left child begins as its parent does, a right child where the left one leaves.
        left = starts.select(*part, F.shiftleft("_run", 1).alias("_run"), "s")
        asked = F.broadcast(left.select(*[F.col(c).alias("_q_" + c) for c in (*part, "_run")], "s"))
        met = steps.join(asked, same_keys(steps, asked, [*part, "_run"], "_q_")).where("s <= hi")
        found = met.groupBy(*part, "_run").agg(F.min_by("out", "hi").alias("to"))
        found = found.select(*[F.col(c).alias("_f_" + c) for c in (*part, "_run")], "to")
        moved = left.join(found, same_keys(left, found, [*part, "_run"], "_f_"), "left")
        right = moved.select(*part, (F.col("_run") + 1).alias("_run"), F.coalesce("to", "s").alias("s"))
        starts = persist_table(left.unionAll(right), "starts")
    lows = wide.select(*[F.col("_w_" + k) for k in part], "_lo")
    return starts.join(F.broadcast(lows), same_keys(starts, lows, part, "_w_")).select(
        *part, (F.col("_run") + F.col("_lo")).alias(SLICE), F.col("s").alias("_open")
    )


def greedy_chunks(
    rows: DataFrame, part: list[str], limit: int, members: str | None = None, split: bool = False, empty: bool = True,
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Chunks of rows with ``_seq`` (order), ``_a``, ``_b``, ``_since`` (start of the row's island) and ``_slice``.

    The rows of a group (of a group in a slice, if ``split``) lie in one partition.  Output: group columns, ``start``
    (``_a`` of the chunk's first row), ``at``, ``stop`` (where the page begins and ends), ``n`` (rows) and, if ``members``
    names a column, ``members`` (structs of it, ``_a`` and ``_b``, in order).  A chunk is one row, or one row for each
    ``page_rows`` members.  Chunks without size are left out unless ``empty``.
    """
    keys = [*part, SLICE] if split else part
    numbers = ("start", "at", "stop", "n", "first")
    fields = [*_fields(rows, keys), *[T.StructField(n, T.LongType()) for n in numbers]]
    narrow = rows.select(*keys, "_seq", "_a", "_b", "_since", *([members] if members and members not in keys else []))
    if members:
        narrow = narrow.withColumn("_member", F.struct(F.col(members), "_a", "_b")).select(*keys, "_seq", "_a", "_b", "_since", "_member")
        fields.append(T.StructField("members", T.ArrayType(narrow.schema["_member"].dataType)))
    held = "_member" if members else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, last = Scan(keys, limit, held, page_rows), None
        for batch in batches:
            if batch.num_rows:
                last = pa.Table.from_batches([batch])
                yield from scan.feed(last).to_batches()
        if last is not None:
            yield from scan.finish(last).to_batches()

    if split:
        opens = _open_at_slices(rows, part, limit).where(F.col("_open") != CLOSED)
        opens = opens.select(*[F.col(k).alias("_o_" + k) for k in keys], "_open")
        first = F.row_number().over(Window.partitionBy(*keys).orderBy("_seq")) == 1
        # A chunk can be open only at a slice that begins inside its group: fewer rows than slices.
        seeded = narrow.withColumn("_first", first).join(F.broadcast(opens), same_keys(narrow, opens, keys, "_o_"), "left")
        opened = F.when(F.col("_first"), F.col("_open"))
        narrow = seeded.select(*narrow.columns, F.coalesce(opened, F.lit(CLOSED)).alias("_open"))
    else:
        narrow = narrow.withColumn("_open", F.lit(CLOSED))
    cut_rows = narrow.sortWithinPartitions(*keys, "_seq").mapInArrow(cut, T.StructType(fields))
    return _joined_up(cut_rows, part, members, split, empty, page_rows)


def _joined_up(cut_rows: DataFrame, part: list[str], members: str | None, split: bool, empty: bool, page_rows: int) -> DataFrame:
    """The chunks of ``greedy_chunks`` from what the scan of each partition gives."""
    columns = [*part, "start", "at", "stop", "n", *(["members"] if members else [])]
    if not split:
        return (cut_rows if empty else cut_rows.where("stop > start")).select(*columns)
    if not members:
        whole = cut_rows.groupBy(*part, "start").agg(F.col("start").alias("at"), F.max_by("stop", SLICE).alias("stop"), F.sum("n").alias("n"))
        return (whole if empty else whole.where("stop > start")).select(*columns)
    # Chunks that lie in several slices, fewer than slices, get their pages anew.
    cut_rows = persist_table(cut_rows, "pieces")
    names = [*part, "start"]
    torn = cut_rows.groupBy(*names).agg(F.min(SLICE).alias("_lo"), F.max(SLICE).alias("_hi"), F.min("first").alias("_first"), F.max("stop").alias("_stop"))
    torn = persist_table(torn.where("_lo < _hi").select(*[F.col(n).alias("_t_" + n) for n in names], "_first", "_stop"), "torn")
    match = same_keys(cut_rows, torn, names, "_t_")
    whole = cut_rows.join(F.broadcast(torn), match, "left_anti").select(*columns)
    pieces = cut_rows.join(F.broadcast(torn), match)
    if not empty:
        whole, pieces = whole.where("stop > start"), pieces.where("_stop > start")
    each = pieces.select(*names, (F.col("first") - F.col("_first")).alias("_from"), F.posexplode("members").alias("_i", "_m"))
    each = each.withColumn("_i", F.col("_from") + F.col("_i")).withColumn("_page", F.expr(f"_i div {page_rows}"))
    paged = each.groupBy(*names, "_page").agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda x: x["_m"]).alias("members"))
    paged = paged.withColumns({"at": F.col("members")[0]["_a"], "stop": F.element_at("members", -1)["_b"], "n": F.size("members").cast("long")})
    return whole.unionByName(paged.select(*columns))


def _chunks_in_order(
    frame: DataFrame, part: list[str], order: list[str | Column], limit: int, members: str | None, split: bool, empty: bool,
    page_rows: int,
) -> DataFrame:
    """``greedy_chunks`` over the running sums of ``_size``, which the scan itself adds up.

    Rows are sorted once and read as a stream, so a task holds one sort; a window and a second sort would hold them again.
    """
    keys = [*part, SLICE] if split else part
    numbers = ("start", "at", "stop", "n", "first")
    fields = [*_fields(frame, keys), *[T.StructField(n, T.LongType()) for n in numbers]]
    if members:
        member = T.StructType([T.StructField(members, frame.schema[members].dataType), *[T.StructField(c, T.LongType()) for c in ("_a", "_b")]])
        fields.append(T.StructField("members", T.ArrayType(member)))
    carried = [members] if members and members not in keys else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        adds, scan, last = Running(keys), Scan(keys, limit, "_member" if members else None, page_rows), None
        for batch in batches:
            if batch.num_rows:
                last = adds.feed(pa.Table.from_batches([batch]))
                if members:
                    parts = [last[c].combine_chunks() for c in (members, "_a", "_b")]
                    last = last.append_column("_member", pa.StructArray.from_arrays(parts, [members, "_a", "_b"]))
                yield from scan.feed(last).to_batches()
        if last is not None:
            yield from scan.finish(last).to_batches()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        adds = Running(keys)
        for batch in batches:
            if batch.num_rows:
                yield from adds.feed(pa.Table.from_batches([batch])).select([*keys, "_seq", "_a", "_b", "_since"]).to_batches()

    def in_order(rows: DataFrame, *columns: str | Column) -> DataFrame:
        return rows.sortWithinPartitions(*keys, *order).select(*keys, "_size", *columns)

    if not split:
        zero = F.lit(0).cast("long")
        rows = in_order(frame, zero.alias("_base"), zero.alias("_base_seq"), F.lit(CLOSED).alias("_open"), *carried)
        return _joined_up(rows.mapInArrow(cut, T.StructType(fields)), part, members, split, empty, page_rows)
    # What precedes each slice in its group.  Rows: at most slices + groups.
    before = Window.partitionBy(*part).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sums = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_sum"))
    sums = sums.select(*[F.col(k).alias("_e_" + k) for k in keys], F.sum("_n").over(before).alias("_base_seq"), F.sum("_sum").over(before).alias("_base"))
    sums = persist_table(sums.where("_base_seq is not null"), "before")
    based = frame.join(F.broadcast(sums), same_keys(frame, sums, keys, "_e_"), "left").select(
        frame["*"], F.coalesce("_base", F.lit(0)).alias("_base"), F.coalesce("_base_seq", F.lit(0)).alias("_base_seq")
    )
    numbered = in_order(based, "_base", "_base_seq", F.lit(CLOSED).alias("_open")).mapInArrow(
        number, T.StructType([*_fields(frame, keys), *[T.StructField(c, T.LongType()) for c in ("_seq", "_a", "_b", "_since")]])
    )
    opens = _open_at_slices(numbered, part, limit).where(F.col("_open") != CLOSED)
    # A chunk can be open only at a slice that begins inside its group: fewer rows than slices.
    opens = opens.select(*[F.col(k).alias("_o_" + k) for k in keys], "_open")
    seeded = based.join(F.broadcast(opens), same_keys(based, opens, keys, "_o_"), "left").select(
        based["*"], F.coalesce("_open", F.lit(CLOSED)).alias("_open")
    )
    rows = in_order(seeded, "_base", "_base_seq", "_open", *carried)
    return _joined_up(rows.mapInArrow(cut, T.StructType(fields)), part, members, split, empty, page_rows)


def _varies(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_varies(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType))


def _together(
    df: DataFrame, part: list[str], order: list[str | Column], others: list[str], alone: bool = False
) -> tuple[DataFrame, bool]:
    """``with_slices``, with the rows of a group (of a group in a slice) in one partition.

    ``alone`` is for plans without windows: each slice gets a partition of its own, and large groups do not meet in one.

    Only the columns the scan needs are moved, unless the order is given by expressions.  Rows that carry texts or binaries may
    be wide: then bytes count too when groups are split.
    """
    wide = any(_varies(df.schema[c].dataType) for c in others)
    if all(isinstance(o, str) for o in order):
        df = df.select(*dict.fromkeys([*part, *order, *others]))
    frame, split = with_slices(df, part, order, by_bytes=wide)
    if split:
        # More partitions than slices, so that few slices meet in one.
        slices = frame.agg(F.max(SLICE)).first()[0] + 1
        if alone:
            return frame.repartitionById(slices, F.col(SLICE).cast("int")), True
        most = max(2 * slices, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return frame.repartition(most, *part, SLICE), True
    if alone and part:
        return frame.repartitionByRange(*part), False
    return (frame.repartition(*part) if part else frame.repartition(1)), False


def chunk(
    df: DataFrame, part: list[str], order: list[str | Column], size: Column, limit: int,
    members: str | None = None, strict: bool = False, carry: dict[str, Column] | None = None, page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Chunks of each group in order, closed after the row that brings the size to ``limit``.

    ``strict`` closes only above the limit and keeps a last chunk of size 0.  Output: group columns, ``offset``
    (sum of the sizes before the chunk), ``total`` and ``n``.  With ``members``, an id column, a chunk is one row for each
    ``page_rows`` members: ``total`` and ``n`` are the page's, ``at`` is where it begins, ``members`` has the ids; with
    ``carry`` it has structs of the id, its offset in the chunk, its length and the named values.
    """
    sized = df.withColumn("_size", F.coalesce(size.cast("long"), F.lit(0)))
    if carry:
        sized = sized.withColumn("_carried", F.struct(F.col(members).alias("id"), *[c.alias(n) for n, c in carry.items()]))
    held = "_carried" if carry else members
    frame, split = _together(sized, part, order, ["_size", *([held] if members else [])], alone=True)
    return _as_extents(_chunks_in_order(frame, part, order, limit + 1 if strict else limit, held, split, strict, page_rows), carry)


def cut_apart(chunks: DataFrame) -> DataFrame:
    """The members of chunks made with ``carry``, one row each: group columns, ``id``, ``offset``, ``length`` and what they carry."""
    groups = [c for c in chunks.columns if c not in ("offset", "at", "total", "n", "members", "payload")]
    each = chunks.select(*groups, F.col("offset").alias("_chunk"), F.explode("members").alias("_m"))
    fields = chunks.schema["members"].dataType.elementType.names
    rest = [F.col("_m")[f].alias(f) for f in fields if f not in ("id", "offset")]
    return each.select(*groups, F.col("_m")["id"].alias("id"), (F.col("_chunk") + F.col("_m")["offset"]).alias("offset"), *rest)


def pack(
    df: DataFrame, part: list[str], order: list[str | Column], key: str, payload: str, limit: int, page_rows: int = PAGE_ROWS
) -> DataFrame:
    """Chunks of binary payloads: extents, members with offset, length and CRC-32, and ``payload``, the bytes of the page."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    chunks = chunk(df, part, order, F.octet_length(body), limit, key, carry={"checksum": F.crc32(body), "body": body}, page_rows=page_rows)
    joined = F.unhex(F.array_join(F.transform("members", lambda m: F.hex(m["body"])), ""))
    slim = F.transform("members", lambda m: m.dropFields("body"))
    return chunks.withColumn("payload", joined).withColumn("members", slim)


def unpack(chunks: DataFrame) -> DataFrame:
    """The payloads of ``pack``, one row for each member: group columns, ``id``, ``payload``, and ``ok``, whether its checksum holds."""
    groups = [c for c in chunks.columns if c not in ("offset", "at", "total", "n", "members", "payload")]
    each = chunks.select(*groups, (F.col("at") - F.col("offset")).alias("_skip"), "payload", F.explode("members").alias("_m"))
    part = F.substring("payload", (F.col("_m")["offset"] - F.col("_skip") + 1).cast("int"), F.col("_m")["length"].cast("int"))
    return each.select(*groups, F.col("_m")["id"].alias("id"), part.alias("payload"), F.col("_m")["checksum"].alias("_sum")).select(
        *groups, "id", "payload", (F.crc32("payload") == F.col("_sum")).alias("ok")
    )


def chunk_islands(
    df: DataFrame, part: list[str], order: list[str | Column], size: Column, limit: int, accepted: Column,
    members: str | None = None,
) -> DataFrame:
    """As ``chunk`` over the accepted rows, also closing where accepted rows are not adjacent.

    Offsets count the sizes of all rows, so a chunk is a contiguous extent of the original order.  Rows that are not
    accepted have a positive size, as only an offset tells two islands apart.
    """
    sized = df.withColumn("_size", F.coalesce(size.cast("long"), F.lit(0)))
    sized = sized.withColumn("_ok", F.coalesce(accepted, F.lit(False)))
    frame, split = _together(sized, part, order, ["_size", "_ok", *([members] if members else [])])
    rows = run_over(
        frame, part, order, split, {"_seq": F.lit(1).cast("long"), "_b": F.col("_size")}, previous={"_was_ok": F.col("_ok")}
    )
    rows = rows.withColumn("_a", F.col("_b") - F.col("_size"))
    begins = F.when(F.col("_ok") & ~F.coalesce("_was_ok", F.lit(False)), F.col("_a"))
    rows = run_over(rows, part, ["_seq"], split, lasts={"_since": begins}).where("_ok")
    return _as_extents(greedy_chunks(rows, part, limit, members, split, empty=False))


def merge_ranges(
    df: DataFrame, part: list[str], offset: str, length: str, limit: int, members: str | None = None,
    tie: list[str] | None = None,
) -> DataFrame:
    """Ranges of each group joined in offset order for fewer, larger reads.

    Two ranges stay apart if the gap between them is over half the limit; a joined range closes when it spans
    ``limit``.  The total of a joined range includes the gaps it swallows.
    """
    order = [offset, *(tie or [])]
    end = F.col(offset) + F.col(length)
    frame, split = _together(df, part, order, [length, *([members] if members else [])])
    gaps = run_over(frame, part, order, split, previous={"_before": end})
    alone = F.col("_before").isNull() | (F.col(offset) - F.col("_before") > limit // 2)
    begins = F.when(alone, F.col(offset).cast("long"))
    rows = run_over(gaps, part, order, split, {"_seq": F.lit(1).cast("long")}, {"_since": begins})
    rows = rows.withColumn("_a", F.col(offset).cast("long")).withColumn("_b", end.cast("long"))
    return _as_extents(greedy_chunks(rows, part, limit, members, split))


def _as_extents(chunks: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """Offsets and totals; members as ids, or as structs with their place in the chunk."""
    groups = [c for c in chunks.columns if c not in ("start", "at", "stop", "n", "members")]
    extent = [F.col("start").alias("offset"), (F.col("stop") - F.col("at")).alias("total"), F.col("n")]
    if "members" not in chunks.columns:
        return chunks.select(*groups, *extent)
    held = chunks.schema["members"].dataType.elementType.names[0]

    def place(m: Column) -> Column:
        return F.struct(m[held]["id"].alias("id"), (m["_a"] - F.col("start")).alias("offset"), (m["_b"] - m["_a"]).alias("length"), *[m[held][n].alias(n) for n in carry])

    shown = F.transform("members", place if carry else lambda m: m[held])
    return chunks.select(*groups, F.col("start").alias("offset"), "at", (F.col("stop") - F.col("at")).alias("total"), "n", shown.alias("members"))
