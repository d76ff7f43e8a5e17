"""Queries over streams: each runs the stream over the whole table and is checked against batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import streaming as st
from millrace.plans.registry import query
from millrace.plans.views import HEARTBEATS_SQL, beats, seconds, text_of
from millrace.session import scratch_path
from millrace.sources import table
from millrace.streaming.liveness import current_status


@query("st_dedupe", "SELECT event_id, user_id, event_type FROM events")
def st_dedupe(spark, folder):
    events = st.stream_table(spark, folder, "events").withColumn("ts", seconds("ts"))
    # Every sender sends twice.
    sent = events.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    once = st.st_dedupe(sent, ["event_id"], "ts", "1 hour").select("event_id", "user_id", "event_type")
    return st.drain(once, "dedupe")


def _in_files(df, order, files):
    """A stream of one file per micro-batch, the table cut by ``order``; file by file as numbered."""
    folder = scratch_path(df.sparkSession, "files")
    for number in range(files):
        df.where(order == number).coalesce(1).write.parquet(f"{folder}/{number}")
    read = df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
    return read.parquet(folder)


@query("st_dedupe_ever", "SELECT event_id, user_id, event_type FROM events")
def st_dedupe_ever(spark, folder):
    # Three files; each row is in two of them, and the newest rows come first.
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    sent = events.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    stream = _in_files(sent, F.pmod(-F.col("event_id") - F.col("copy"), F.lit(3)), 3)
    return st.dedupe_ever(stream, ["event_id"], ["copy"]).select("event_id", "user_id", "event_type")


@query("st_liveness", f"""
WITH {HEARTBEATS_SQL}, last_beat AS (
  SELECT user_id, max(ts) AS ts, max_by(status, (ts, status)) AS status FROM heartbeats GROUP BY user_id)
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_seen,
       CASE WHEN (SELECT max(ts) FROM heartbeats) - ts > INTERVAL 6 HOUR THEN 'LOST' ELSE status END AS status
FROM last_beat""")
def st_liveness(spark, folder):
    stream = beats(st.stream_table(spark, folder, "events"))
    changes = st.drain(st.liveness(stream, "user_id", "ts", "status", 6 * 3600), "liveness")
    return current_status(changes, "user_id").select("user_id", text_of("last_seen").alias("last_seen"), "status")


@query("st_idle_expiry", f"""
WITH {HEARTBEATS_SQL}, gaps AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new
  FROM heartbeats),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS session FROM gaps)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen,
       count(*) AS n
FROM numbered GROUP BY user_id, session HAVING (SELECT max(ts) FROM heartbeats) - max(ts) > INTERVAL 6 HOUR""")
def st_idle_expiry(spark, folder):
    stream = beats(st.stream_table(spark, folder, "events"))
    ended = st.drain(st.idle_stream(stream, "user_id", "ts", 6 * 3600), "idle")
    return ended.select("user_id", text_of("first_seen").alias("first_seen"), text_of("last_seen").alias("last_seen"), "n")


_QUOTA_SQL = """
WITH ranked AS (
  SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer)
SELECT c_nationkey, c_custkey, CASE WHEN rn <= CASE WHEN n_regionkey = 2 THEN 9 ELSE 5 END THEN 1 ELSE 0 END AS admitted
FROM ranked JOIN nation ON n_nationkey = c_nationkey"""


@query("st_quota", _QUOTA_SQL)
def st_quota(spark, folder):
    overrides = table(spark, folder, "nation").where("n_regionkey = 2").select(
        F.col("n_nationkey").alias("c_nationkey"), F.lit(9).alias("quota")
    )
    stream = st.stream_table(spark, folder, "customer").select("c_nationkey", "c_custkey", F.col("c_custkey").alias("at"))
    verdicts, _ = st.quota(stream, "c_nationkey", "c_custkey", "at", overrides)
    return verdicts.select("c_nationkey", "c_custkey", F.col("admitted").cast("int").alias("admitted"))


@query("st_retry_counter", """
WITH failures AS (
  SELECT user_id % 5 AS parent, user_id, CAST(day(ts) AS INTEGER) AS attempt FROM events WHERE event_type = 'error'),
newest AS (SELECT parent, max(attempt) AS attempt FROM failures GROUP BY parent)
SELECT parent, user_id, attempt, count(*) AS failures FROM failures JOIN newest USING (parent, attempt)
GROUP BY parent, user_id, attempt""")
def st_retry_counter(spark, folder):
    events = st.stream_table(spark, folder, "events").where("event_type = 'error'")
    failures = events.select((F.col("user_id") % 5).alias("parent"), "user_id", F.dayofmonth("ts").alias("attempt"))
    return st.retry_counter(failures, "parent", "user_id", "attempt", 2)[1]


@query("st_retry_alarms", """
WITH failures AS (
  SELECT user_id % 5 AS parent, user_id, CAST(day(ts) AS INTEGER) AS attempt FROM events WHERE event_type = 'error')
SELECT parent, user_id, attempt, count(*) AS failures FROM failures GROUP BY parent, user_id, attempt HAVING count(*) >= 2""")
def st_retry_alarms(spark, folder):
    events = st.stream_table(spark, folder, "events").where("event_type = 'error'")
    failures = events.select((F.col("user_id") % 5).alias("parent"), "user_id", F.dayofmonth("ts").alias("attempt"))
    return st.retry_counter(failures, "parent", "user_id", "attempt", 2)[0]


@query("st_quota_reloaded", """
WITH customers AS (SELECT c_nationkey, c_custkey, c_custkey % 2 AS file FROM customer),
ranked AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey, file ORDER BY c_custkey) AS rn,
                  count(*) OVER (PARTITION BY c_nationkey) AS n FROM customers),
first_file AS (SELECT c_nationkey, c_custkey, file, rn <= 5 AS admitted FROM ranked WHERE file = 0),
live AS (SELECT c_nationkey, count(*) AS live FROM first_file WHERE admitted GROUP BY c_nationkey)
SELECT c_nationkey, c_custkey, CASE WHEN admitted THEN 1 ELSE 0 END AS admitted FROM first_file
UNION ALL
SELECT r.c_nationkey, r.c_custkey,
       CASE WHEN rn <= CASE WHEN r.c_nationkey % 2 = 0 THEN 8 ELSE 5 END - coalesce(live, 0) THEN 1 ELSE 0 END AS admitted
FROM ranked r LEFT JOIN live l ON l.c_nationkey = r.c_nationkey WHERE file = 1""")
def st_quota_reloaded(spark, folder):
    # Customers come in two files; with the second one, a new quota arrives for the nations with even numbers.
    rows = table(spark, folder, "customer").select("c_nationkey", "c_custkey", F.col("c_custkey").alias("at"), F.lit(None).cast("int").alias("quota"))
    news = table(spark, folder, "nation").where("n_nationkey % 2 = 0").select(
        F.col("n_nationkey").cast(rows.schema["c_nationkey"].dataType).alias("c_nationkey"), F.lit(None).cast(rows.schema["c_custkey"].dataType).alias("c_custkey"),
        F.lit(None).cast(rows.schema["at"].dataType).alias("at"), F.lit(8).alias("quota"),
    )
    lines = _in_files(rows.unionAll(news), F.when(F.col("quota").isNotNull(), 1).otherwise((F.col("c_custkey") % 2).cast("int")), 2)
    verdicts, _ = st.quota(lines, "c_nationkey", "c_custkey", "at", lines.where("quota is not null").select("c_nationkey", "quota"))
    return verdicts.select("c_nationkey", "c_custkey", F.col("admitted").cast("int").alias("admitted"))


@query("st_size_batches", """
WITH RECURSIVE steps AS MATERIALIZED (
  SELECT user_id, event_id, 1 + event_id % 40 AS size, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos
  FROM events),
walk AS (
  SELECT user_id, pos, event_id, size AS acc, event_id AS first FROM steps WHERE pos = 1
  UNION ALL
  SELECT s.user_id, s.pos, s.event_id, CASE WHEN c.acc >= 150 THEN s.size ELSE c.acc + s.size END,
         CASE WHEN c.acc >= 150 THEN s.event_id ELSE c.first END
  FROM walk c JOIN steps s ON s.user_id = c.user_id AND s.pos = c.pos + 1)
SELECT user_id, max(acc) AS total, count(*) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY pos) AS members
FROM walk GROUP BY user_id, first""")
def st_size_batches(spark, folder):
    events = st.stream_table(spark, folder, "events")
    rows = events.select("user_id", "event_id", (1 + F.col("event_id") % 40).alias("size"))
    out = st.size_batches(rows, "user_id", "event_id", "size", 150)
    return out.withColumn("members", F.concat_ws(",", F.col("members").cast("array<string>")))


@query("st_running_totals", """
SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum, max(user_id) AS top_user
FROM events GROUP BY event_type""")
def st_running_totals(spark, folder):
    events = st.stream_table(spark, folder, "events")
    measures = {"n": F.count(F.lit(1)), "id_sum": F.sum("event_id"), "top_user": F.max("user_id")}
    return st.latest(st.totals(events, ["event_type"], measures), "totals")


@query("st_reloaded_list", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority IN (SELECT o_orderpriority FROM orders GROUP BY 1 HAVING count(*) > (SELECT count(*) / 5.0 FROM orders))""")
def st_reloaded_list(spark, folder):
    # The list file names the priorities with more than their share of orders.
    path = scratch_path(spark, "list")
    orders = table(spark, folder, "orders")
    many = orders.groupBy("o_orderpriority").count().where(F.col("count") > orders.count() / 5.0)
    many.select(F.concat(F.lit(" "), "o_orderpriority").alias("value")).write.text(path)
    stream = st.stream_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return st.with_list(stream, "o_orderpriority", path, "allow")


@query("st_late_rows", """
SELECT o_orderkey, o_custkey, CASE WHEN c_custkey IS NULL THEN 0 ELSE 1 END AS accepted
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey""")
def st_late_rows(spark, folder):
    owners = table(spark, folder, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    stream = st.stream_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    rows = st.drain(st.split_rejected(stream, owners, "o_custkey"), "late")
    return rows.withColumn("accepted", F.col("accepted").cast("int"))
