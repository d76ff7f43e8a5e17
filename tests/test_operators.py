"""Worked examples and odd inputs."""

import itertools
import zlib

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace import functions as fn
from millrace import sources as src
from millrace.operators import aggregates, audit, exchange, joins, ordered, picking, placement, project, sets, sorts
from millrace.plans.aggregates import _two_largest
from millrace.session import scratch_path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_tokens_keep_inner_and_drop_trailing_empties(spark):
    df = spark.createDataFrame([("a  b ",), ("",), ("  ",), (" a",)], "t string")
    assert [r[0] for r in df.select(fn.tokens(F.col("t"))).collect()] == [["a", "", "b"], [""], [], ["", "a"]]


def test_pack_id_round_trip_and_limits(spark):
    top = [(0, 0, 0), ((1 << 18) - 1, (1 << 24) - 1, (1 << 21) - 1), (3, 2, 1)]
    df = spark.createDataFrame(top, "s long, p long, t long")
    packed = df.select("*", fn.pack_id(F.col("s"), F.col("p"), F.col("t")).alias("id"))
    back = packed.select("s", "p", "t", *fn.unpack_id(F.col("id")).values()).collect()
    assert all(r[:3] == r[3:] for r in back) and packed.agg(F.max("id")).first()[0] == (1 << 63) - 1
    for bad in [(1 << 18, 0, 0), (0, 1 << 24, 0), (0, 0, 1 << 21), (-1, 0, 0)]:
        with pytest.raises(PySparkException):
            spark.createDataFrame([bad], "s long, p long, t long").select(
                fn.pack_id(F.col("s"), F.col("p"), F.col("t"))).collect()


def test_crc32_is_zlib(spark):
    texts = ["", "a", "naïve ✓", "x" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(fn.crc32(F.col("t"))).collect()] == [zlib.crc32(t.encode()) for t in texts]


def test_small_expressions(spark):
    one = spark.range(1)
    assert one.select(fn.metric_name(F.lit("a-b.c")), fn.metric_name(F.lit(None).cast("string"))).first()[:] == ("a_b_c", "")
    assert one.select(fn.fmt_ts(F.lit(1704067199999))).first()[0] == "2023-12-31 23:59:59"
    assert one.select(*fn.range_of(F.lit(9), 4, 10)).first()[:] == (8, 11)
    assert one.select(*fn.range_of(F.lit(10), 4, 10)).first()[:] == (None, None)


@pytest.mark.parametrize("items, width, at_once, runs", [
    (52, 2, 20, [2] * 11 + [1] * 4), (48, 2, 20, [2] * 10 + [1] * 4), (96, 2, 30, [3] * 15 + [1] * 3),
    (48, 1, 20, [4] * 10 + [2] * 3 + [1] * 2), (26, 2, 4, [1] * 13), (2, 2, 4, [1]), (12, 2, 0, [1] * 6),
    (24, 2, 50, [2] * 5 + [1] * 2),
])
def test_contiguous_runs(spark, items, width, at_once, runs):
    df = placement.contiguous(spark.range(items), ["id"], 5, width, at_once)
    buckets = [r.bucket for r in df.select("range", "bucket").distinct().orderBy("range").collect()]
    assert [(b, len(list(g))) for b, g in itertools.groupby(buckets)] == [(i % 5, n) for i, n in enumerate(runs)]


def test_contiguous_copies_spread_the_load(spark):
    df = placement.contiguous(spark.range(98), ["id"], 5, 2, 20, 3).select("range", "copy", "bucket").distinct()
    assert [r["count"] for r in df.groupBy("bucket").count().orderBy("bucket").collect()] == [29, 29, 30, 30, 29]


def test_round_robin_replicas(spark):
    got = placement.round_robin(spark.range(4), ["id"], 3, 2).orderBy("id", "copy").collect()
    assert [(r.id, r.bucket) for r in got] == [(0, 0), (0, 1), (1, 2), (1, 0), (2, 1), (2, 2), (3, 0), (3, 1)]


@pytest.mark.parametrize("limit", ["4000000", "60"])
def test_running_values_do_not_depend_on_the_plan(spark, limit):
    spark.conf.set("spark.millrace.groupRows", limit)
    try:
        df = spark.range(1000).select(
            F.when(F.col("id") % 10 < 7, 1).when(F.col("id") % 10 < 9, 2).alias("g"), "id",
            F.when(F.col("id") % 13 == 0, F.col("id")).alias("v"),
        )
        out = ordered.running(df, ["g"], ["id"], {"s": F.col("id")}, {"last": F.col("v")}, {"prev": F.col("id")})
        by_group = {}
        for r in out.orderBy("id").collect():
            total, last, prev = by_group.get(r.g, (0, None, None))
            last = r.v if r.v is not None else last
            assert (r.s, r["last"], r.prev) == (total + r.id, last, prev)
            by_group[r.g] = (total + r.id, last, r.id)
        alone = ordered.row_index(df.select("id"), [], [F.col("id").desc()])
        assert all(r.idx == 999 - r.id for r in alone.collect())
    finally:
        spark.conf.unset("spark.millrace.groupRows")


def test_budget_pick_is_the_loop(spark):
    import random

    rnd = random.Random(5)
    for _ in range(5):
        sizes = [(i, rnd.randint(1, 50)) for i in range(40)]
        budget, threshold, picked, expected = 300, 20, 0, []
        for key, size in sorted(sizes, key=lambda p: (-p[1], p[0])):
            if picked > budget or not (size > threshold or picked <= budget // 2):
                break
            picked += size
            expected.append(key)
        df = spark.createDataFrame(sizes, "k int, size int")
        got = picking.budget_pick(df, "k", "size", 400, 100, threshold)
        assert sorted(r.k for r in got.collect()) == sorted(expected)


@pytest.mark.parametrize("limit", ["4000000", "3"])
def test_prefer_healthy_second_round(spark, limit):
    spark.conf.set("spark.millrace.groupRows", limit)
    try:
        df = spark.createDataFrame([(1, i, i in (0, 2)) for i in range(5)], "item int, o int, bad boolean")
        got = picking.prefer_healthy(df, "item", ["o"], F.col("bad"), 2, 4)
        assert rows(got.select("round", "o")) == [(1, 1), (1, 3), (2, 0), (2, 2)]
        assert rows(picking.prefer_healthy(df, "item", ["o"], F.col("bad"), 4, 4).select("round", "o")) == [
            (1, 0), (1, 1), (1, 3), (1, 4)]
    finally:
        spark.conf.unset("spark.millrace.groupRows")


def test_pick_attempt_needs_all_tasks(spark):
    events = spark.createDataFrame(
        [(0, 10, 1, "ok"), (0, 11, 2, "ok"), (1, 12, 3, "ok"), (1, 12, 4, "gone"), (1, 13, 5, "ok")],
        "task int, attempt int, at int, kind string")
    args = ("task", "attempt", "at", F.col("kind") == "ok", F.col("kind") == "gone")
    assert rows(picking.pick_attempt(events, *args, tasks=2)) == [(0, 10), (1, 13)]
    for tasks in (1, 3):
        with pytest.raises(PySparkException):
            picking.pick_attempt(events, *args, tasks=tasks).collect()


def test_place_keeps_and_spreads(spark):
    entities, targets = spark.range(200), spark.range(4).select(F.col("id").alias("t"), (F.col("id") != 2).alias("ok"))
    existing = entities.where("id < 100").select("id", (F.col("id") % 4).alias("t"))
    got = {r.id: r.t for r in picking.place(entities, existing, targets, "id", "t", F.col("ok")).collect()}
    assert len(got) == 200 and all(got[i] == i % 4 for i in range(100) if i % 4 != 2)
    assert {got[i] for i in range(100, 200)} == {0, 1, 3} and all(t != 2 for t in got.values())
    nowhere = picking.place(entities, existing, targets, "id", "t", F.lit(False))
    assert nowhere.where("t IS NOT NULL").count() == 0


def test_health_without_members(spark):
    empty = spark.createDataFrame([], "ok boolean, used long, total long")
    assert aggregates.health(empty, None, F.col("ok"), F.col("used"), F.col("total"), 50).first().healthy is False


def test_quorum_settings():
    aggregates.check_quorum(3, 2, 2)
    for bad in [(3, 1, 2), (3, 4, 1), (0, 0, 0)]:
        with pytest.raises(ValueError):
            aggregates.check_quorum(*bad)


def test_combine_runs_spills_held_keys(spark):
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby("k", as_index=False, dropna=False).agg(v=("v", "sum"))

    key = F.when(F.col("id") % 700 > 0, (F.col("id") % 700).cast("string"))
    df = spark.range(5000).select(key.alias("k"), F.lit(1).cast("long").alias("v"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    got = aggregates.combine_runs(df, "k", "k string, v long", add, held_keys=150)
    assert sets.diff(got, df.groupBy("k").agg(F.sum("v").alias("v"))).isEmpty() and got.count() == 700
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_combine_runs_seldom_combines_a_row_anew(spark):
    def add(frame):
        frame = frame.groupby("k", as_index=False).agg(v=("v", "sum"), times=("times", "max"))
        return frame.assign(times=frame["times"] + 1)

    df = spark.range(0, 2000, 1, 1).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v"), F.lit(0).cast("long").alias("times"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    got = aggregates.combine_runs(df, "k", "k long, v long, times long", add).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.k, r.v) for r in got) == [(k, 1) for k in range(2000)]
    # Of 200 batches of a map task: about once for each doubling.
    assert max(r.times for r in got) < 20


def test_two_largest_values_of_each_user():
    nan = float("nan")
    frame = pd.DataFrame({"user_id": [1, 1, 1, 2, nan, nan, 3, 3, 4], "top": [5.0, 5, 7, 1, 2, 3, nan, 4, nan], "second": [6.0, nan, nan, 1, nan, nan, nan, 4, nan]})
    got = _two_largest(frame).astype(object).where(lambda f: f.notna(), None)
    assert [tuple(r) for r in got[["user_id", "top", "second"]].to_numpy()] == [(1, 7, 6), (2, 1, None), (3, 4, None), (None, 3, 2)]


def test_cross_counts_copies(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "a int"), spark.createDataFrame([(7,), (7,)], "b int")
    assert rows(joins.cross([a, b], ["a", "b"])) == [(1, 7, 4), (2, 7, 2)]
    assert joins.cross([a, b], ["a", "b"]).schema["n"].dataType.simpleString() == "bigint"
    assert rows(joins.cross([a, b.limit(0)], ["a", "b"])) == []


def test_cross_counts_more_copies_than_a_long_holds(spark):
    same = spark.range(1000).select(F.lit(1).alias("a"))
    other = same.unionAll(same.limit(1).select(F.lit(2)))
    got = rows(joins.cross([same] * 6 + [other], list("abcdefg")))
    assert got == [(1, 1, 1, 1, 1, 1, 1, 10**21), (1, 1, 1, 1, 1, 1, 2, 10**18)]


def test_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, None), ("a", 2)], "k string, v int")
    assert [tuple(r) for r in aggregates.count_by(df, "k", "v").collect()] == [(None, 1), ("a", 1)]
    assert rows(aggregates.group_by_key(df, "k", "v")) == [("a", 0, [2]), (None, 0, [None, 1])]
    assert rows(src.route_huge_groups(df, "k", F.lit(1), 1)) == [("a", 2, "warm"), (None, 1, "cold"), (None, None, "cold")]


def test_partition_numbers_are_checked(spark):
    df = spark.range(20)
    placed = exchange.by_partitioner(df, 4, F.col("id") % 4).withColumn("at", F.spark_partition_id())
    assert placed.where("at <> id % 4").count() == 0 and placed.rdd.getNumPartitions() == 4
    with pytest.raises(PySparkException):
        exchange.by_partitioner(df, 4, F.col("id")).collect()
    with pytest.raises(PySparkException):
        src.range_layout(df, "id", 4, 10).collect()


def test_exchanges_place_rows(spark):
    df = spark.range(1000).select((F.col("id") % 37).alias("k"), "id")
    at = F.spark_partition_id().alias("at")
    hashed = exchange.by_hash(df, 6, "k").select("k", at).distinct()
    assert hashed.count() == 37
    ranged = exchange.by_range(df, 5, "id").select("id", at).groupBy("at").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    spans = sorted((r.lo, r.hi) for r in ranged.collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and len(spans) == 5
    assert exchange.evenly(df, 5).rdd.getNumPartitions() == 5
    assert exchange.adaptive(spark.range(10), "id").rdd.getNumPartitions() < 8


def test_watched_counts_rows(spark):
    df, seen = exchange.watched(spark.range(77), "rows")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 77


def test_secondary_sort_order(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("a"), (F.hash("id") % 50).alias("b"))
    got = [tuple(r) for r in sorts.secondary_sort(df, "a", "b").collect()]
    assert got == sorted(got)


def test_text_sink_is_in_order_over_files(spark):
    path = scratch_path(spark, "t")
    src.sink_sorted_text(spark.range(500).repartition(7), path, F.lpad(F.col("id").cast("string"), 4, "0"), "id")
    files = src.scan_text(spark, path).withColumn("f", F.input_file_name()).groupBy("f")
    files = files.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    spans = [(r.lo, r.hi) for r in files.orderBy("f").collect()]
    assert spans == sorted(spans) and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_missing_folder_is_empty(spark):
    assert src.scan_glob(spark, scratch_path(spark, "none"), "a", ".txt").count() == 0


def test_hash_spread_is_in_range(spark):
    got = src.hash_spread(spark.range(500), ["id"], 7).groupBy("sink").count().collect()
    assert {r.sink for r in got} == set(range(7)) and min(r["count"] for r in got) > 30


def test_lists_ignore_comments_and_blanks(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    listed = spark.createDataFrame([(" a ",), ("",), ("  ",), ("# b",)], "line string")
    assert rows(project.allow(df, "id", listed)) == [("a",)]
    assert rows(project.deny(df, "id", listed)) == [("b",), ("c",)]


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "g long, k long, v long, ok boolean")
    order = ["k", "v"]
    outs = [
        aggregates.count_by(empty, "g", "v"), aggregates.group_by_key(empty, "g", "v"), ordered.row_index(empty, ["g"], order),
        ordered.row_index(empty, [], order), picking.dedupe(empty, ["k"], order), picking.budget_pick(empty, "k", "v", 9, 1, 3),
        picking.diverse_topk(empty, 3, "g", order, "prefer"), picking.prefer_healthy(empty, "g", order, F.col("ok"), 1, 2),
        placement.round_robin(empty, order, 3), placement.contiguous(empty, order, 3, 2, 5), sorts.largest(empty, "v", 3),
        sets.diff(empty, empty), audit.audit_complete(empty, empty, "g", "k"), audit.retry_flags(empty, "g", "k", "v", 2),
        joins.join_salted(empty, empty.select("k", F.col("v").alias("w")), "k"), joins.missing(empty, empty, "k"),
        joins.cogroup_n([empty, empty], "k", "v"), aggregates.quorum(empty, "k", "v", F.col("ok"), 3, 2, 2),
        ordered.switch_state(empty, ["g"], order, F.col("v"), 9, 3), aggregates.read_stats(empty, "g", F.col("ok"), F.col("v"), F.col("v")),
    ]
    assert [o.count() for o in outs] == [0] * len(outs)


def test_diff_finds_rows_and_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    assert rows(sets.diff(a, b)) == [(1, 2, 1), (2, 1, 0), (3, 0, 1)]
    assert sets.diff(a, a.repartition(3)).isEmpty()


def test_hysteresis_marks(spark):
    levels = [50, 90, 85, 70, 60, 59, 75, 95, 60]
    df = spark.createDataFrame([("e", i, v) for i, v in enumerate(levels)], "e string, t int, v int")

    def states(**kw):
        return [r.state for r in ordered.switch_state(df, ["e"], ["t"], F.col("v"), 90, 60, **kw).orderBy("t").collect()]

    assert states() == ["on", "off", "off", "off", "on", "on", "on", "off", "on"]
    assert states(strict_low=True) == ["on", "off", "off", "off", "off", "on", "on", "off", "off"]
    with pytest.raises(ValueError):
        ordered.switch_state(df, ["e"], ["t"], F.col("v"), 60, 60)


def test_many_first_rows_of_a_large_group(spark, small_groups):
    df = spark.range(5000).select((F.col("id") % 4 == 3).alias("g"), "id")
    got = ordered.first_rows(df, ["g"], [F.col("id").desc()], 1500, "r")
    assert rows(got.groupBy("g").agg(F.count("r"), F.max("r"), F.min("id"))) == [
        (False, 1500, 1500, 3000), (True, 1250, 1250, 3)]


@pytest.mark.parametrize("limit", ["4000000", "20"])
def test_resume_page_cursors(spark, limit):
    spark.conf.set("spark.millrace.groupRows", limit)
    try:
        df = spark.range(60).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"), F.lit(10).alias("s"))
        cursors = spark.createDataFrame([(0, 30), (1, 58), (2, 999)], "g long, cursor long")
        page = ordered.resume_page(df, ["g"], ["k"], "k", F.col("s"), cursors, 25)
        # After 30; nothing after the last row; unknown, so from the start.
        assert rows(page.select("g", "k")) == [(0, 33), (0, 36), (0, 39), (2, 2), (2, 5), (2, 8)]
        odd = ordered.resume_page(df, ["g"], ["k"], "k", F.col("s"), cursors.where("g = 9"), 15, F.col("k") % 2 == 1)
        assert rows(odd.select("g", "k")) == [(0, 3), (0, 9), (1, 1), (1, 7), (2, 11), (2, 5)]
    finally:
        spark.conf.unset("spark.millrace.groupRows")


def test_status_and_percent(spark):
    data = [(2, "LOST", 1, 0), (1, "ACTIVE", 5, 10), (3, "ACTIVE", 4, 10)]
    df = spark.createDataFrame(data, "id int, s string, a int, t int")
    assert [r.id for r in project.by_status(df, "id", "s").collect()] == [1, 2, 3]
    assert [r.id for r in project.by_status(df, "id", "s", "ACTIVE").collect()] == [1, 3]
    assert rows(project.pct_at_least(df, F.col("a"), F.col("t"), 50).select("id")) == [(1,)]


def test_pick_target_prefers_healthy_and_held(spark):
    entities = spark.createDataFrame([("x",), ("y",)], "e string")
    held = spark.createDataFrame([("y", "t9")], "e string, t string")
    targets = spark.createDataFrame([("t1", False, 0), ("t2", True, 7), ("t3", True, 4)], "t string, ok boolean, n int")
    pick = lambda ok: rows(picking.pick_target(entities, targets, held, "e", "t", ok, F.col("n")))
    assert pick(F.col("ok")) == [("x", "t3"), ("y", "t9")]
    assert pick(F.lit(False)) == [("x", "t1"), ("y", "t9")]


@pytest.fixture
def plain_plans(spark):
    """No plans made at run time, no broadcasts by size: what the operators ask for is what is seen."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_spreads_a_key_hot_on_both_sides(spark, plain_plans):
    """Equal rows of a hot key are spread as well, and no task gets twice the mean."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(3000).select(F.when(F.col("id") < 1200, 7).when(F.col("id") < 1300, None).otherwise(F.col("id")).alias("k"), F.lit(1).alias("v"))
        right = spark.range(2000).select(F.when(F.col("id") < 900, 7).otherwise(F.col("id") + 1000).alias("k"), F.lit(2).alias("w"))
        salted = joins.join_salted(left, right, "k")
        per_task = [r["n"] for r in salted.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).where("n > 1000").collect()]
        assert sum(per_task) >= 1200 * 900 and max(per_task) <= 2 * 1200 * 900 / 16
        assert sets.diff(salted, left.join(right, "k")).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("hot", ["left", "right"])
def test_salted_join_with_one_hot_side(spark, plain_plans, hot):
    many = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    few = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    left, right = (many, few) if hot == "left" else (few, many)
    salted = joins.join_salted(left, right, "k")
    assert salted.columns == left.join(right, "k").columns and sets.diff(salted, left.join(right, "k")).isEmpty()
    tasks = salted.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 4 and max(t["count"] for t in tasks) < 1334 / 2


def test_salted_join_without_hot_keys_is_a_plain_join(spark):
    df = spark.range(100).select("id", (F.col("id") + 1).alias("v"))
    salted = joins.join_salted(df, df.withColumnRenamed("v", "w"), "id")
    assert salted.count() == 100 and "Union" not in salted._jdf.queryExecution().toString()


def test_equal_values_fill_pages(spark):
    """15,000 equal values of one key come in 15 pages, whatever fits one task."""
    df = spark.range(15_100).select(F.lit(1).alias("k"), F.when(F.col("id") < 15_000, "x").otherwise(F.col("id").cast("string")).alias("v"))
    for limit in ("1000", "4000000"):
        spark.conf.set("spark.millrace.groupRows", limit)
        try:
            pages = aggregates.group_by_key(df, "k", "v", 1000).collect()
        finally:
            spark.conf.unset("spark.millrace.groupRows")
        pages = sorted(pages, key=lambda r: r.page)
        assert [len(r["values"]) for r in pages] == [1000] * 15 + [100]
        assert [v for r in pages for v in r["values"]] == [str(i) for i in range(15_000, 15_100)] + ["x"] * 15_000


def test_equal_order_values_are_split(spark):
    """Rows of one group with one order value are numbered in many slices."""
    spark.conf.set("spark.millrace.groupRows", "1000")
    try:
        df = spark.range(6000).select(F.lit(1).alias("g"), F.lit(5).alias("o"), F.col("id") % 3)
        found = sorts.position_in_group(df, "g", ["o"])
        assert sorted(r.pos for r in found.collect()) == list(range(6000))
    finally:
        spark.conf.unset("spark.millrace.groupRows")


def test_wide_rows_are_not_broadcast(spark, plain_plans):
    left = spark.range(10_000).select("id")
    wide = spark.range(1000).select("id", F.repeat(F.lit("x"), 100_000).alias("body"), F.array(F.repeat(F.lit("y"), 10)).alias("list"))
    joined = joins.join_bcast(left, wide, "id")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    narrow = joins.join_bcast(left, wide.select("id", "list"), "id")
    assert "BroadcastHashJoin" in narrow._jdf.queryExecution().executedPlan().toString()


def test_dense_ids(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 5 > 0, F.col("id") % 40_000).alias("v"))
    assert aggregates.count_dense_ids(df, "v").first().n == aggregates.count_ids(df, "v").first().n == 32_000


def test_prefer_healthy_keeps_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "a", 0), (1, "b", 0), (1, "c", 0)], "item long, source string, bad int")
    found = []
    for limit in ("1000", "1"):
        spark.conf.set("spark.millrace.groupRows", limit)
        found.append(sorted(map(tuple, picking.prefer_healthy(df, "item", ["source"], F.col("bad") == 1, 2, 4).collect())))
    spark.conf.unset("spark.millrace.groupRows")
    assert found[0] == found[1] and len(found[0]) == 4


def test_quorum_counts_replicas(spark):
    df = spark.createDataFrame([(1, 0, True), (1, 0, True), (2, 0, True), (2, 1, True), (2, 2, False)], "id long, replica int, ok boolean")
    assert sorted(map(tuple, aggregates.quorum(df, "id", "replica", F.col("ok"), 3, 2, 2).collect())) == [(1, 1, False), (2, 2, True)]


def test_chained_exchanges_stay(spark):
    from millrace.operators import exchange

    plan = exchange.chained(spark.range(100), "id", 4, 16)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning(4)" in plan and "RoundRobinPartitioning(16)" in plan
