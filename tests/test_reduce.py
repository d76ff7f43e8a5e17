"""A user's own aggregates, reducers and table functions; id sets as bitmaps; jobs before an action."""

import itertools

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.operators import hooks, idsets, ordered, reduce

KIND = "k int, v int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=["3", "10000"])
def batch_rows(spark, request):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", request.param)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def sizes(key, pages):
    pages = list(pages)
    yield pd.DataFrame({"k": pd.array([key[0]], "Int64"), "n": [sum(map(len, pages))], "most": [max(map(len, pages))], "text": [",".join(str(v) for p in pages for v in p["v"])]})


def test_groups_come_in_pages(spark, batch_rows):
    data = [(k, v) for k, n in [(1, 25), (2, 1), (None, 7), (4, 3)] for v in range(n)]
    df = spark.createDataFrame(data, KIND).repartition(4)
    got = reduce.reduce_groups(df, ["k"], [F.desc("v")], "k int, n long, most long, text string", sizes, page_rows=10).collect()
    assert {(r.k, r.n) for r in got} == {(1, 25), (2, 1), (None, 7), (4, 3)} and max(r.most for r in got) <= 10
    assert all(r.text == ",".join(str(v) for v in reversed(range(r.n))) for r in got)
    assert reduce.reduce_groups(df.limit(0), ["k"], ["v"], "k int, n long, most long, text string", sizes).count() == 0


def heads(key, pages):
    first = next(pages)
    yield pd.DataFrame({"k": pd.array([key[0]], "Int64"), "v": [int(first["v"].iloc[0])]})


def test_pages_that_are_not_read_are_passed_over(spark, batch_rows):
    df = spark.createDataFrame([(k, v) for k in range(5) for v in range(20)], KIND)
    assert rows(reduce.reduce_groups(df, ["k"], ["v"], KIND, heads, page_rows=4)) == [(k, 0) for k in range(5)]


def both(key, left, right):
    a = [v for p in left for v in p["v"]]
    b = [v for p in right for v in p["w"]]
    yield pd.DataFrame({"k": pd.array([key[0]], "Int64"), "a": [str(a)], "b": [str(b)]})


def right_only(key, left, right):
    b = [v for p in right for v in p["w"]]
    yield pd.DataFrame({"k": pd.array([key[0]], "Int64"), "a": [""], "b": [str(b)]})


@pytest.mark.parametrize("function", [both, right_only])
def test_pairs_of_groups(spark, batch_rows, function):
    left = [(1, 3), (1, 1), (2, 5), (None, 9), *[(7, v) for v in range(12)]]
    right = [(1, "x"), (3, "y"), (3, "z"), (None, "n")]
    a, b = spark.createDataFrame(left, KIND), spark.createDataFrame(right, "k int, w string")
    got = {r.k: (r.a, r.b) for r in reduce.reduce_pairs(a, b, ["k"], "k int, a string, b string", function, (["v"], ["w"]), page_rows=5).collect()}
    keys = {k for k, _ in left + right}
    wanted = {k: (str(sorted(v for q, v in left if q == k)) if function is both else "", str(sorted(w for q, w in right if q == k))) for k in keys}
    assert got == wanted


def kinds(key, pages):
    for page in pages:
        yield key[0], len(page), str(page["v"].dtype), str(page["b"].dtype), [None if pd.isna(v) else int(v) for v in page["v"]][-1], list(page.index)[-1]


def test_rows_as_tuples_and_pages_with_nulls(spark, batch_rows):
    big = (1 << 62) + 1
    data = [(1.0, big, True), (1.0, big + 2, True), (-0.0, 5, False), (0.0, 6, None), (float("nan"), 7, True), (float("nan"), 8, True), (None, None, True)]
    df = spark.createDataFrame(data, "k double, v long, b boolean").coalesce(1)
    got = reduce.reduce_groups(df, ["k"], ["v"], "k double, n int, v string, b string, last long, at int", kinds, page_rows=2).collect()
    found = sorted((repr(r.k), r.n, r.v, r.b, r.last, r.at) for r in got if r.k in (1.0, 0.0) and r.n == 2)
    assert ("1.0", 2, "int64", "bool", big + 2, 1) in found or spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "3"
    assert {(r.last, r.v, r.b) for r in got} >= {(big + 2, "int64", "bool"), (6, "int64", "object"), (8, "int64", "bool"), (None, "float64", "bool")}


def test_runs_of_keys():
    for values, kind in [([1.0, 1.0, -0.0, 0.0, float("nan"), float("nan"), None, None], pa.float64()), ([None, "a", "a", "b"], pa.string()),
                         ([{"x": 1}, {"x": 1}, None, {"x": 2}], pa.struct([("x", pa.int64())])), ([True, True, False], pa.bool_())]:
        wanted = [not reduce._equal((x,), (y,)) for x, y in zip(values[1:], values)]
        assert reduce._changes(pa.array(values, kind)).tolist() == wanted


def test_results_of_many_groups_leave_in_one_batch():
    schema = pa.schema([("k", pa.int64()), ("x", pa.float64())])
    out = reduce._Out(schema)
    early = [b for k in range(500) for b in out.add(iter([pd.DataFrame({"k": [k], "x": [None if k < 100 else 1.5]})]))]
    early += [b for k in range(500) for b in out.add(iter([(k, float("nan"))]))]
    batches = [*early, *out.rest()]
    assert len(batches) == 3 and sum(b.num_rows for b in batches) == 1000
    assert pa.Table.from_batches(batches)["x"].null_count == 600


def longest(frame):
    return frame.sort_values("s", key=lambda s: s.str.len(), ascending=False, kind="stable").groupby("k", as_index=False, dropna=False).first()


@pytest.mark.parametrize("held", [1, 100_000])
@pytest.mark.parametrize("parts", [1, 7])
def test_aggregate_does_not_depend_on_its_runs(spark, batch_rows, held, parts):
    data = [(k, "x" * ((k * 7 + i * 5) % 31)) for k in range(6) for i in range(40)]
    df = spark.createDataFrame(data, "k int, s string").repartition(parts)
    found = reduce.aggregate(
        df, "k", "k int, s string", "k int, n long", partial=longest, merge=longest,
        finish=lambda f: pd.DataFrame({"k": f["k"], "n": f["s"].str.len()}), held_keys=held,
    )
    assert rows(found) == [(k, max(len(s) for q, s in data if q == k)) for k in range(6)]


class Changes:
    def __init__(self):
        self.last, self.k, self.n = None, None, 0

    def eval(self, row):
        self.n += self.last is not None and row["v"] != self.last
        self.k, self.last = row["k"], row["v"]

    def terminate(self):
        yield self.k, self.n


def test_table_function_sees_a_group_in_order(spark):
    data = [(k, v) for k in range(4) for v in (1, 1, 2, 2 + k, 9)]
    found = hooks.table_function(spark.createDataFrame(data, KIND).repartition(3), Changes, "k int, n int", ["k"], ["v"])
    wanted = {k: sum(a != b for a, b in itertools.pairwise(sorted(v for q, v in data if q == k))) for k in range(4)}
    assert dict(rows(found)) == wanted


def test_bitmaps_are_sets(spark):
    df = spark.range(200_000).select((F.col("id") % 3).cast("int").alias("g"), (F.col("id") % 70_001).alias("v"))
    df = df.unionByName(spark.createDataFrame([(0, None), (9, 5)], "g int, v long"))
    sets = idsets.bitmaps(df, ["g"], "v")
    assert rows(idsets.cardinality(sets, ["g"])) == rows(df.where("v is not null").groupBy("g").agg(F.countDistinct("v")))
    assert rows(idsets.members(sets, ["g"], "v")) == rows(df.where("v is not null").distinct())
    twice = idsets.united([sets, sets], ["g"])
    assert rows(twice) == rows(sets)


def test_thin_ids_stay_rows(spark):
    thin = spark.range(2000).select((F.col("id") * 1_000_003).alias("v"))
    dense = spark.range(100_000).select((F.col("id") % 50_000).alias("v"))
    below = spark.range(100_000).select((F.col("id") % 50_000 - 7).alias("v"))
    assert not idsets.is_dense(thin, [], "v") and idsets.is_dense(dense, [], "v") and not idsets.is_dense(below, [], "v")
    assert not idsets.is_dense(thin.limit(0), [], "v")
    for df in (thin, dense, below):
        assert rows(idsets.union_distinct([df, df], "v")) == rows(df.distinct())


def test_dense_sets_shuffle_less_than_a_byte_for_an_id(spark):
    df = spark.range(0, 1_000_000, 1, 4).select((F.col("id") % 500_000).alias("v"))
    sets = idsets.bitmaps(df, [], "v")
    sent = 4 * sets.count() * idsets.BITMAP_BYTES  # at most one bitmap of each bucket from each of 4 tasks
    assert sent < 500_000 and idsets.cardinality(sets, []).first().n == 500_000


def test_few_jobs_before_the_action(spark):
    df = spark.range(3000).select((F.col("id") % 5).alias("g"), "id", F.lit(1).alias("s"))
    cursors = spark.range(5).select(F.col("id").alias("g"), (F.col("id") + 100).alias("cursor"))
    spark.sparkContext.setJobGroup("before", "plan")
    try:
        page = ordered.resume_page(df, ["g"], ["id"], "id", F.col("s"), cursors, 10)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("before"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 2
    assert rows(page.groupBy("g").agg(F.min("id"), F.count("id"))) == [(g, 105 + g if g < 5 else 0, 10) for g in range(5)]
    exact = ordered.resume_page(df, ["g"], ["id"], "id", F.col("s"), cursors, 10, F.col("id") % 2 == 0)
    assert exact.count() == 50 and exact.where("id % 2 = 1").isEmpty()
