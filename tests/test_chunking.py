"""Greedy chunks against loops over the same rows, with whole and with split groups."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators.chunking import CLOSED, Cuts, Running, _together, chunk, chunk_islands, cut_apart, merge_ranges, pack, unpack


def loop_chunks(sizes, limit, strict=False):
    out, start, total, n = [], 0, 0, 0
    for s in sizes:
        total, n = total + s, n + 1
        if total > limit if strict else total >= limit:
            out.append((start, total, n))
            start, total, n = start + total, 0, 0
    if n if strict else total:
        out.append((start, total, n))
    return out


def assert_merged(ranges, limit, merged):
    """What holds for merged ranges and for nothing else: see the four properties."""
    ranges, merged = sorted(ranges), sorted(merged)
    starts = [offset for offset, _ in merged]
    members = [[r for r in ranges if a <= r[0] < b] for a, b in zip(starts, [*starts[1:], float("inf")])]
    assert sum(members, []) == ranges  # every range is in one merged range
    ends = [[o + n for o, n in m] for m in members]
    for (offset, total), inside, end in zip(merged, members, ends):
        assert (offset, offset + total) == (inside[0][0], end[-1])  # it reaches from its first range to its last
        assert all(o - e <= limit // 2 for (o, _), e in zip(inside[1:], end))  # no inner gap above half the limit
        assert all(e - offset < limit for e in end[:-1])  # closed at the first end that reaches the limit, no later
    for (_, total), end, after in zip(merged, ends, members[1:]):
        assert total >= limit or after[0][0] - end[-1] > limit // 2  # and never sooner without a gap


def loop_islands(rows, limit):
    out, offset, start, total, n, open_at = [], 0, None, 0, 0, None
    for i, (size, ok) in enumerate(rows):
        if n and (total >= limit or (ok and i - open_at != 1)):
            out.append((start, total, n))
            total, n = 0, 0
        if ok:
            start = offset if n == 0 else start
            total, n, open_at = total + size, n + 1, i
        offset += size
    return out + ([(start, total, n)] if total else [])


@pytest.fixture(params=["4000000", "400"])
def group_rows(spark, request):
    spark.conf.set("spark.millrace.groupRows", request.param)
    yield
    spark.conf.unset("spark.millrace.groupRows")


@pytest.mark.parametrize("limit, strict", [(1, False), (37, False), (300, True), (100_000, False)])
def test_chunk(spark, group_rows, limit, strict):
    rnd = random.Random(limit)
    groups = {g: [rnd.choice([0, 1, 2, 5, 9, 40]) for _ in range(n)] for g, n in [(0, 3000), (1, 30), (None, 7)]}
    data = [(g, i, s) for g, sizes in groups.items() for i, s in enumerate(sizes)]
    df = spark.createDataFrame(data, "g int, i int, s int").repartition(5)
    rows = chunk(df, ["g"], ["i"], F.col("s"), limit, "i", strict).collect()
    for g, sizes in groups.items():
        mine = sorted((r for r in rows if r.g == g), key=lambda r: r.members)
        assert [(r.offset, r.total, r.n) for r in mine] == loop_chunks(sizes, limit, strict)
        members = [i for r in mine for i in r.members]
        assert members == list(range(len(members)))


@pytest.mark.parametrize("limit", [5, 50, 10_000])
def test_merge_ranges(spark, group_rows, limit):
    rnd = random.Random(limit)
    groups = {}
    for g, n in [(0, 2000), (1, 40)]:
        at, groups[g] = 0, []
        for _ in range(n):
            at += rnd.choice([0, 0, 0, 3, 10, 60])
            groups[g].append((at, rnd.choice([1, 4, 9])))
            at += groups[g][-1][1]
    df = spark.createDataFrame([(g, *r) for g, rs in groups.items() for r in rs], "g int, o long, n long")
    rows = merge_ranges(df.repartition(5), ["g"], "o", "n", limit).collect()
    for g, ranges in groups.items():
        assert_merged(ranges, limit, [(r.offset, r.total) for r in rows if r.g == g])


@pytest.mark.parametrize("limit", [3, 200])
def test_chunk_islands(spark, group_rows, limit):
    rnd = random.Random(limit)
    rows = [(rnd.choice([1, 2, 5]), rnd.random() < 0.95) for _ in range(2500)]
    df = spark.createDataFrame([(1, i, s, ok) for i, (s, ok) in enumerate(rows)], "g int, i int, s int, ok boolean")
    got = chunk_islands(df, ["g"], ["i"], F.col("s"), limit, F.col("ok")).collect()
    assert sorted((r.offset, r.total, r.n) for r in got) == loop_islands(rows, limit)


def through(start, his, outs):
    return next((o for h, o in zip(his, outs) if start <= h), start)


@pytest.mark.parametrize("seed", range(30))
def test_steps_follow_the_scan(seed):
    """A run cut in two gives the same chunks when its steps are followed as when it is scanned whole."""
    rnd = random.Random(seed)
    n, limit = rnd.randint(2, 60), rnd.choice([1, 4, 15, 60])
    sizes = np.array([rnd.randint(1, 6) for _ in range(n)])
    b = np.cumsum(sizes)
    a = b - sizes
    since, current = [], 0
    for i in range(n):
        current = a[i] if i == 0 or rnd.random() < 0.1 else current
        since.append(current)
    since = np.array(since)
    def starts(run, i):
        out = set()
        while i < len(run.a):
            out.add(int(run.a[i]))
            i = run.next_start(i)
        return out

    whole = starts(Cuts(a, b, since, limit), 0)
    found, opened = set(), CLOSED
    bounds = sorted({0, n, *[rnd.randint(0, n) for _ in range(3)]})
    for lo, hi in zip(bounds, bounds[1:]):
        run = Cuts(a[lo:hi], b[lo:hi], since[lo:hi], limit)
        goes_on = opened != CLOSED and opened >= since[lo]
        found |= starts(run, run.next_start(0, opened) if goes_on else 0)
        opened = through(opened, *run.steps(int(since[lo])))
    assert found == whole


@pytest.mark.parametrize("batch_rows", [1, 7, 10_000])
def test_chunks_over_arrow_batches(spark, batch_rows):
    """Open chunks are carried from batch to batch and from group to group."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    try:
        data = [(g, i, (i * 7 + g) % 11) for g in range(40) for i in range(30)]
        rows = chunk(spark.createDataFrame(data, "g int, i int, s int"), ["g"], ["i"], F.col("s"), 25, "i").collect()
        for g in range(40):
            expected = loop_chunks([s for k, _, s in data if k == g], 25)
            assert sorted((r.offset, r.total, r.n) for r in rows if r.g == g) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_overlapping_ranges(spark):
    ranges = [(0, 50), (10, 5), (20, 4), (60, 3), (61, 30), (62, 1), (200, 9)]
    df = spark.createDataFrame([(1, o, n) for o, n in ranges], "g int, o long, n long")
    got = merge_ranges(df, ["g"], "o", "n", 40).collect()
    assert_merged(ranges, 40, [(r.offset, r.total) for r in got])


@settings(max_examples=60, deadline=None)
@given(
    lengths=st.lists(st.integers(1, 9), min_size=1, max_size=40), gaps=st.lists(st.integers(0, 30), min_size=40, max_size=40),
    limit=st.integers(1, 60), cuts=st.lists(st.integers(1, 39), max_size=4),
)
def test_folded_slices_are_the_whole_scan(lengths, gaps, limit, cuts):
    """Steps of slices, folded in blocks as the operator does, find the chunk open at every slice."""
    n = len(lengths)
    gaps = np.array(gaps[:n])
    b = np.cumsum(lengths) + np.cumsum(gaps)
    a = b - np.array(lengths)
    since = np.maximum.accumulate(np.where((gaps > limit // 2) | (np.arange(n) == 0), a, 0))
    bounds = sorted({0, n, *[c for c in cuts if c < n]})
    runs = [Cuts(a[lo:hi], b[lo:hi], since[lo:hi], limit).steps(int(since[lo])) for lo, hi in zip(bounds, bounds[1:])]
    whole = Cuts(a, b, since, limit).steps(int(since[0]))
    for opened in [CLOSED, *range(int(a[0]) - 70, int(a[0]))]:
        step_by_step = opened
        for r in runs:
            step_by_step = through(step_by_step, *r)
        assert through(opened, *whole) == step_by_step


@pytest.mark.parametrize("batch_rows", [3, 10_000])
def test_pages_of_members(spark, group_rows, batch_rows):
    """No list is longer than a page, in a task or over slices, and the pages of a chunk follow one another."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    try:
        rnd = random.Random(3)
        sizes = [rnd.choice([0, 1, 2]) for _ in range(2500)]
        df = spark.createDataFrame([(1, i, s) for i, s in enumerate(sizes)], "g int, i int, s int").repartition(4)
        rows = sorted(chunk(df, ["g"], ["i"], F.col("s"), 900, "i", page_rows=64).collect(), key=lambda r: r.members)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert max(len(r.members) for r in rows) == 64 and all(r.n == len(r.members) for r in rows)
    assert [i for r in rows for i in r.members] == list(range(2500))
    ends = np.cumsum([0, *sizes])
    assert all(r.at == ends[r.members[0]] and r.at + r.total == ends[r.members[-1] + 1] for r in rows)
    chunks = {}
    for r in rows:
        before = chunks.get(r.offset, (0, 0))
        chunks[r.offset] = before[0] + r.total, before[1] + r.n
    assert [(o, *c) for o, c in sorted(chunks.items())] == loop_chunks(sizes, 900)


def test_one_chunk_over_many_slices(spark):
    """A chunk that is open all the way: the functions of 40 slices are composed, and nothing is collected."""
    spark.conf.set("spark.millrace.groupRows", "100")
    try:
        df = spark.range(2000).select(F.lit(1).alias("g"), F.col("id").cast("int").alias("i"), F.lit(1).alias("s"))
        got = chunk(df, ["g"], ["i"], F.col("s"), 700).collect()
        assert sorted((r.offset, r.total, r.n) for r in got) == [(0, 700, 700), (700, 700, 700), (1400, 600, 600)]
        got = chunk(df, [], ["i"], F.col("s"), 10**9).collect()
        assert [(r.offset, r.total, r.n) for r in got] == [(0, 2000, 2000)]
    finally:
        spark.conf.unset("spark.millrace.groupRows")


def test_chunks_are_cut_apart_again(spark, group_rows):
    rows = [(i % 3, i, bytes([i % 256]) * (i % 7)) for i in range(900)] + [(None, 1000, None), (0, 2000, b"end")]
    df = spark.createDataFrame(rows, "g int, i int, body binary")
    packed = pack(df, ["g"], ["i"], "i", "body", 50, page_rows=4)
    assert all(r.total == len(r.payload) and r.n <= 4 for r in packed.collect())
    assert sorted(map(tuple, unpack(packed).collect()), key=str) == sorted([(g, i, b or b"", True) for g, i, b in rows if g is not None], key=str)
    broken = packed.withColumn("payload", F.concat(F.lit(b"x"), F.expr("substring(payload, 2)")))
    assert not all(r.ok for r in unpack(broken).collect())
    whole = chunk(df, ["g"], ["i"], F.length("body"), 50, "i", strict=True, carry={"crc": F.crc32("body")})
    found = {(r.g, r.id): (r.offset, r.length, r.crc) for r in cut_apart(whole).collect()}
    assert len(found) == len(rows) and found[0, 0][:2] == (0, 0) and found[1, 4][:2] == (1, 4)


def test_groups_of_few_wide_rows_are_split(spark):
    rows = [("a" if i % 5 else None, i, bytes([i % 251]) * (i % 7 * 40)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, id long, body binary")
    spark.conf.set("spark.millrace.groupBytes", "8000")
    try:
        assert _together(df, ["g"], ["id"], ["body"])[1] and not _together(df.limit(20), ["g"], ["id"], ["body"])[1]
        packed = pack(df, ["g"], ["id"], "id", "body", 1000)
        extents = sorted(tuple(r) for r in packed.where("g = 'a'").select("offset", "total", "n").collect())
        assert extents == loop_chunks([len(b) for g, _, b in rows if g], 1000)
        assert sorted(map(tuple, unpack(packed).collect()), key=str) == sorted([(*r, True) for r in rows], key=str)
    finally:
        spark.conf.unset("spark.millrace.groupBytes")


def test_a_task_sorts_a_group_once(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), "id", F.lit(2).cast("long").alias("len"))
    chunks = chunk(rows, ["g"], ["id"], F.col("len"), 10, "id", carry={"x": F.col("len")})
    plan = chunks._jdf.queryExecution().sparkPlan().toString()
    assert "Window" not in plan and plan.count("Sort [") == 1
    found = chunks.where("g = 1").orderBy("offset").first()
    assert found["total"] == 10 and [tuple(m) for m in found["members"]] == [(1 + 3 * i, 2 * i, 2, 2) for i in range(5)]


@pytest.mark.parametrize("step", [1, 2, 5, 100])
def test_running_sums_over_batches(step):
    keys = [None, None, 0.0, -0.0, 0.0, 1.5, float("nan"), float("nan"), float("nan")]
    size, base, number = [3, 1, -2, 5, 0, 7, 1, 1, 1], [0, 0, 10, 10, 10, 0, 4, 4, 4], [0, 0, 2, 2, 2, 0, 1, 1, 1]
    rows = pa.table({"k": pa.array(keys, pa.float64()), "_size": size, "_base": base, "_base_seq": number, "_open": [9] * 9})
    adds = Running(["k"])
    out = pa.concat_tables([adds.feed(rows.slice(i, step)) for i in range(0, 9, step)])
    assert out["_b"].to_pylist() == [3, 4, 8, 13, 13, 7, 5, 6, 7]
    assert out["_a"].to_pylist() == [0, 3, 10, 8, 13, 0, 4, 5, 6]
    assert out["_seq"].to_pylist() == [1, 2, 3, 4, 5, 1, 2, 3, 4]
    assert out["_open"].to_pylist() == [9, CLOSED, 9, CLOSED, CLOSED, 9, 9, CLOSED, CLOSED]
    with pytest.raises(OverflowError):
        Running([]).feed(pa.table({"_size": [1 << 62, 1 << 62], "_base": [0, 0], "_base_seq": [0, 0], "_open": [CLOSED] * 2}))
