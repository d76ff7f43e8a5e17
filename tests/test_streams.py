"""Streams fed in several micro-batches give what one batch gives."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace import streaming as st
from millrace.operators.chunking import chunk
from millrace.session import scratch_path
from millrace.streaming.liveness import current_status

START = dt.datetime(2024, 1, 1)


def feed(spark, name, batches, schema):
    """A stream with one micro-batch per list of rows."""
    folder = scratch_path(spark, name)
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{i}")
    # The file source takes files by modification time.
    read = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
    return read.parquet(folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def test_liveness_lost_and_back(spark):
    schema = "e int, ts timestamp, s string"
    stream = feed(spark, "beats", [
        [(1, at(0), "ACTIVE"), (2, at(5), "UNHEALTHY")], [(2, at(100), "ACTIVE")], [(2, at(161), "ACTIVE")],
        [(1, at(170), "ACTIVE"), (2, at(171), "UNHEALTHY")],
    ], schema)
    log = st.drain(st.liveness(stream, "e", "ts", "s", 60), "live")
    assert (1, at(0), "LOST") in rows(log)
    assert rows(current_status(log, "e")) == [(1, at(170), "ACTIVE"), (2, at(171), "UNHEALTHY")]


def test_liveness_timeout_is_strict(spark):
    schema = "e int, ts timestamp, s string"
    stream = feed(spark, "edge", [[(1, at(0), "ACTIVE"), (2, at(60), "ACTIVE")]], schema)
    assert rows(current_status(st.drain(st.liveness(stream, "e", "ts", "s", 60), "live"), "e"))[0][2] == "ACTIVE"


def test_quota_expiry_frees_places(spark):
    schema = "o string, e int, ts timestamp"
    overrides = spark.createDataFrame([("b", 1)], "o string, quota int")
    stream = feed(spark, "apps", [
        [("a", i, at(i)) for i in range(4)] + [("b", 10, at(0)), ("b", 11, at(1))],
        [("a", 0, at(50)), ("a", 7, at(51)), ("b", 12, at(52))],
        [("a", 8, at(100)), ("b", 13, at(200))],
    ], schema)
    verdicts, live = st.quota(stream, "o", "e", "ts", overrides, default=3, ttl_seconds=60)
    got = {(r.o, r.e): r.admitted for r in verdicts.collect() if (r.o, r.e) != ("a", 0)}
    assert got == {
        ("a", 1): True, ("a", 2): True, ("a", 3): False, ("b", 10): True, ("b", 11): False,
        ("a", 7): False, ("b", 12): False, ("a", 8): True, ("b", 13): True,
    }
    assert rows(live.select("o", "e")) == [("a", 0), ("a", 8), ("b", 13)]


def test_read_quotas(spark):
    path = scratch_path(spark, "quota")
    spark.createDataFrame([("# x = 1",), ("",), ("ann = 4",), ("bob=7",)], "value string").coalesce(1).write.text(path)
    assert rows(st.read_quotas(spark, path)) == [("ann", 4), ("bob", 7)]


def test_retry_counter_resets_on_a_new_attempt(spark):
    schema = "p int, g int, a int"
    stream = feed(spark, "fails", [
        [(1, 1, 0), (1, 2, 0), (2, 1, 5)], [(1, 1, 0)], [(1, 2, 1)], [(1, 1, 0), (1, 2, 1), (2, 1, 5)], [(1, 2, 1)],
    ], schema)
    fired, counters = st.retry_counter(stream, "p", "g", "a", 2)
    assert rows(fired) == [(1, 1, 0, 2), (1, 2, 1, 2), (2, 1, 5, 2)]
    assert rows(counters) == [(1, 2, 1, 3), (2, 1, 5, 2)]


@pytest.mark.parametrize("limit", [7, 40])
def test_size_batches_are_the_chunks(spark, limit):
    data = [(i % 3, i, (i * 7) % 11) for i in range(200)]
    stream = feed(spark, "sizes", [data[:70], data[70:71], data[71:150], data[150:]], "g int, i int, s int")
    whole = chunk(spark.createDataFrame(data, "g int, i int, s int"), ["g"], ["i"], F.col("s"), limit, "i")
    assert rows(st.size_batches(stream, "g", "i", "s", limit)) == rows(whole.select("g", "total", "n", "members"))


def test_dedupe_over_batches(spark):
    stream = feed(spark, "dup", [[(1, at(0)), (1, at(1)), (2, at(2))], [(1, at(3)), (3, at(4))]], "id int, ts timestamp")
    assert rows(st.drain(st.st_dedupe(stream, ["id"], "ts", "1 hour"), "dd").select("id")) == [(1,), (2,), (3,)]


def test_idle_sessions_end_after_the_ttl(spark):
    stream = feed(spark, "idle", [
        [(1, at(0)), (1, at(60)), (2, at(10))], [(1, at(121)), (2, at(130))], [(3, at(400))],
    ], "e int, ts timestamp")
    ended = st.drain(st.idle_stream(stream, "e", "ts", 60), "idle")
    assert rows(ended) == [
        (1, at(0), at(60), 2), (1, at(121), at(121), 1), (2, at(10), at(10), 1), (2, at(130), at(130), 1)]


def test_totals_grow(spark):
    stream = feed(spark, "tot", [[("a", 1)], [("a", 2), ("b", 5)]], "k string, v long")
    out = st.latest(st.totals(stream, ["k"], {"n": F.count("v"), "total": F.sum("v")}), "tot")
    assert rows(out) == [("a", 2, 3), ("b", 1, 5)]


def _lists(spark, mode):
    """Three micro-batches; the list is [x], then rewritten before the second and gone before the third."""
    path = scratch_path(spark, "list")

    def write(*names):
        spark.createDataFrame([(n,) for n in names], "value string").coalesce(1).write.mode("overwrite").text(path)

    def gone():
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

    changes = iter([lambda: write("x"), lambda: write("y", "# x"), gone])
    original = st.folds._path

    def turn(session, what):
        if what == path:
            next(changes)()
        return original(session, what)

    st.folds._path = turn
    try:
        stream = feed(spark, "ids", [[("x", 1), ("y", 1)], [("x", 2), ("y", 2)], [("x", 3), ("y", 3)]], "id string, b int")
        return rows(st.with_list(stream, "id", path, mode))
    finally:
        st.folds._path = original


def test_a_missing_allow_list_keeps_the_old_one(spark):
    assert _lists(spark, "allow") == [("x", 1), ("y", 2), ("y", 3)]


def test_a_missing_deny_list_is_cleared(spark):
    assert _lists(spark, "deny") == [("x", 2), ("x", 3), ("y", 1), ("y", 3)]


def test_rows_of_unknown_or_expired_owners_are_rejected(spark):
    owners = spark.createDataFrame([("a", None), ("b", at(10))], "o string, gone timestamp")
    batches = [[("a", at(99)), ("b", at(5))], [("b", at(11)), ("z", at(1)), (None, at(1))]]
    stream = feed(spark, "own", batches, "o string, ts timestamp")
    out = st.drain(st.split_rejected(stream, owners, "o", "ts", "gone"), "rej")
    assert rows(out.where("accepted").select("o")) == [("a",), ("b",)] and out.where("NOT accepted").count() == 3


def test_dedupe_past_any_watermark(spark):
    """Ids at hours 10, 20 and 1 in three files all come out once."""
    hour = 3600
    batches = [[(1, at(10 * hour)), (1, at(10 * hour + 1))], [(2, at(20 * hour)), (1, at(11 * hour))], [(3, at(hour)), (2, at(0)), (None, at(5)), (None, at(6))]]
    schema = "id int, ts timestamp"
    got = st.dedupe_ever(feed(spark, "ever", batches, schema), ["id"], ["ts"])
    assert rows(got) == sorted([(1, at(10 * hour)), (2, at(20 * hour)), (3, at(hour)), (None, at(5))], key=repr)
    assert st.dedupe_ever(feed(spark, "none", [[]], schema), ["id"]).count() == 0


def test_history_is_joined_up_and_survives_a_second_run(spark):
    from millrace.streaming.history import History

    path = scratch_path(spark, "history")
    history = History(spark, path, "_k0 int, _bucket int")
    for number in range(5):
        history.write(spark.createDataFrame([(number, number % 2)], "_k0 int, _bucket int"), number, number)
    history.join_up(4)
    assert history.folders(5) == [(0, 3), (4, 4)] and history.folders(4) == [(0, 3)]
    assert rows(history.read(5)) == [(n, n % 2) for n in range(5)] and rows(history.read(4, [1])) == [(1, 1), (3, 1)]
    history.write(spark.createDataFrame([(9, 1)], "_k0 int, _bucket int"), 4, 4)
    assert rows(history.read(5, [1])) == [(1, 1), (3, 1), (9, 1)]


def test_dedupe_over_many_batches(spark):
    batches = [[(i % 7, i) for i in range(n * 3, n * 3 + 3)] for n in range(6)]
    got = st.dedupe_ever(feed(spark, "many", batches, "id int, n int"), ["id"], ["n"], buckets=3, join_up=2)
    assert rows(got) == [(i, i) for i in range(7)]


def test_a_batch_writes_the_state_of_its_own_owners(spark):
    """A micro-batch with 1 % of the owners changes 1 % of the state, and the verdicts are those of the batch function."""
    from millrace.streaming.keyed import quota_run

    schema = "o int, e int, at long"
    first = [(o, e, e) for o in range(300) for e in range(2)]
    second = [(o, 10 + e, 10 + e) for o in range(3) for e in range(4)]
    none = spark.createDataFrame([], "o int, quota int")
    run, verdicts, live = quota_run(feed(spark, "owners", [first, second], schema), "o", "e", "at", none, 4)
    changed = [sum(s["numRowsUpdated"] for s in p["stateOperators"]) for p in run.progress if p["numInputRows"]]
    assert len(changed) == 2 and changed[1] <= changed[0] * 3 / 300 * 2
    expected = rows(st.quota_admit(spark.createDataFrame(first + second, schema), "o", "e", "at", none, 4))
    assert rows(verdicts) == expected
    assert live.count() == sum(r[4] for r in expected)
    again = quota_run(feed(spark, "again", [first, second], schema), "o", "e", "at", none, 4)[1]
    assert rows(again) == expected


def test_quota_timers_free_idle_owners(spark):
    schema = "o string, e int, ts timestamp"
    none = spark.createDataFrame([], "o string, quota int")
    batches = [[("a", 1, at(0)), ("b", 1, at(0))], [("b", 2, at(500))], [("b", 3, at(900))]]
    _, live = st.quota(feed(spark, "timed", batches, schema), "o", "e", "ts", none, 3, ttl_seconds=60, delay="0 seconds")
    assert ("a", 1) not in {(r.o, r.e) for r in live.collect()}  # nothing of "a" came after
    _, live = st.quota(feed(spark, "untimed", batches, schema), "o", "e", "ts", none, 3, ttl_seconds=60)
    assert rows(live.select("o", "e")) == [("a", 1), ("b", 3)]


def test_quotas_follow_their_files(spark):
    schema = "o string, e int, at long"
    folder = scratch_path(spark, "quota-files")
    spark.createDataFrame([("a = 1",), ("# b = 9",), ("b =",), ("b = x",), ("nothing",), ("b = 2 = 3",)], "value string").coalesce(1).write.text(f"{folder}/1")
    stream = feed(spark, "followed", [[("a", i, i) for i in range(3)] + [("b", i, i) for i in range(3)]], schema)
    lines = st.follow_quotas(spark, folder).withColumnRenamed("owner", "o")
    verdicts, live = st.quota(stream, "o", "e", "at", lines, default=2)
    assert rows(live.select("o", "e")) == [("a", 0), ("b", 0), ("b", 1)]


def test_late_rows_are_counted_and_a_delay_keeps_them(spark):
    batches = [[(1, at(1000))], [(2, at(1010))], [(3, at(10)), (2, at(1011))], [(1, at(5000))]]
    stream = feed(spark, "late", batches, "e int, ts timestamp")
    ended, late = st.drain_counted(st.idle_stream(stream, "e", "ts", 60), "late")
    assert late == 1 and 3 not in {r.e for r in ended.collect()}
    ended, late = st.drain_counted(st.idle_stream(stream, "e", "ts", 60, "1 hour"), "kept")
    assert late == 0 and (3, at(10), at(10), 1) in rows(ended)
