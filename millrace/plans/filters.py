"""Queries over projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import project as ops
from millrace.plans.registry import query
from millrace.plans.views import (
    HEARTBEATS_SQL, LEDGER_ORDER, LEDGER_SQL, ORDER_SQL, TOKENS_SQL, accepted, heartbeats, ledger, lines,
)
from millrace.sources import table
from millrace.streaming.liveness import liveness_at


@query("project_case_key", """
SELECT o_orderkey, CASE WHEN o_custkey < 250 THEN 249 WHEN o_custkey > 750 THEN 1000 ELSE o_custkey END AS k FROM orders""")
def project_case_key(spark, folder):
    key = F.col("o_custkey")
    cases = [(key < 250, F.lit(249).cast("long")), (key > 750, F.lit(1000).cast("long"))]
    return ops.rewrite_key(table(spark, folder, "orders"), "k", cases, key).select("o_orderkey", "k")


@query("flatmap_tokens", f"WITH {TOKENS_SQL} SELECT doc_id, token, count(*) AS n FROM tokens GROUP BY doc_id, token")
def flatmap_tokens(spark, folder):
    tokens = ops.explode_tokens(lines(spark, folder), "line")
    return tokens.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


@query("filter_required", f"""
WITH {LEDGER_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, attempt, len FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {ORDER_SQL}) AS rn FROM ledger
  WHERE attempt <= 5 AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'))
WHERE rn = 1""")
def filter_required(spark, folder):
    rows = ledger(spark, folder)
    expected = table(spark, folder, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    kept = ops.required(rows, expected, accepted(rows), "l_orderkey", "attempt", LEDGER_ORDER)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "attempt", "len")


@query("filter_partition_range", f"WITH {LEDGER_SQL} SELECT l_orderkey, l_partkey, g FROM ledger WHERE g >= 3 AND g < 9")
def filter_partition_range(spark, folder):
    return ops.between_parts(ledger(spark, folder), "g", 3, 9).select("l_orderkey", "l_partkey", "g")


@query("filter_attempt_range", f"""
WITH {LEDGER_SQL} SELECT l_orderkey, l_partkey, g, attempt FROM ledger WHERE attempt IN (1, 4)""")
def filter_attempt_range(spark, folder):
    rows = ledger(spark, folder).select("l_orderkey", "l_partkey", "g", "attempt")
    ids = rows.select("attempt").where("attempt IN (1, 4)")
    return ops.slice_attempts(rows, "attempt", ids).select("l_orderkey", "l_partkey", "g", "attempt")


@query("filter_tags_all", """
SELECT user_id, CAST(day(ts) AS INTEGER) AS d, count(DISTINCT event_type) AS n_tags FROM events GROUP BY 1, 2
HAVING max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) = 1
   AND max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) = 1""")
def filter_tags_all(spark, folder):
    # A set of event types is as small as there are types.
    events = table(spark, folder, "events")
    tagged = events.groupBy("user_id", F.dayofmonth("ts").alias("d")).agg(F.collect_set("event_type").alias("tags"))
    kept = ops.has_all(tagged, "tags", ["error", "purchase"])
    return kept.select("user_id", "d", F.size("tags").cast("long").alias("n_tags"))


@query("filter_allowlist", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%'""")
def filter_allowlist(spark, folder):
    orders = table(spark, folder, "orders")
    listed = orders.where("o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%'").select("o_orderpriority").distinct()
    listed = listed.select(F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("entry"))
    listed = listed.unionByName(orders.select(F.lit(" ").alias("entry")).limit(1))
    return ops.allow(orders, "o_orderpriority", listed).select("o_orderkey", "o_orderpriority")


@query("filter_denylist", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'error')")
def filter_denylist(spark, folder):
    events = table(spark, folder, "events")
    types = events.select("event_type").distinct()
    entry = (
        F.when(F.col("event_type").isin("click", "error"), F.concat(F.lit(" "), "event_type", F.lit("\t ")))
        .otherwise(F.concat(F.lit(" # "), "event_type"))
    )
    listed = types.select(F.translate(entry, "\t", " ").alias("entry"))
    return ops.deny(events, "event_type", listed).select("event_id", "event_type")


@query("filter_entity_status", f"""
WITH {HEARTBEATS_SQL}, last_beat AS (
  SELECT user_id, max(ts) AS ts, max_by(status, (ts, status)) AS status FROM heartbeats GROUP BY user_id)
SELECT user_id, CAST(ts AS VARCHAR) AS last_seen FROM last_beat
WHERE status = 'UNHEALTHY' AND (SELECT max(ts) FROM heartbeats) - ts <= INTERVAL 6 HOUR ORDER BY user_id""")
def filter_entity_status(spark, folder):
    rows = heartbeats(spark, folder)
    now = rows.agg(F.max("ts")).first()[0]
    current = liveness_at(rows, "user_id", "ts", "status", F.lit(now), 6 * 3600)
    chosen = ops.by_status(current, "user_id", "status", "UNHEALTHY")
    return chosen.select("user_id", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen"))


@query("filter_pct_threshold", """
SELECT p_partkey, p_size FROM part WHERE CAST(p_retailprice AS DOUBLE) / (CAST(p_size * 100 AS DOUBLE) / 100.0) >= 50""")
def filter_pct_threshold(spark, folder):
    part = table(spark, folder, "part")
    return ops.pct_at_least(part, F.col("p_retailprice"), F.col("p_size") * 100, 50).select("p_partkey", "p_size")
