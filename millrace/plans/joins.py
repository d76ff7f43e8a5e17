"""Queries over joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import joins as ops
from millrace.plans.registry import query
from millrace.plans.views import LEDGER_SQL, accepted, ledger, skewed
from millrace.sources import table

SKEWED_SQL = """
SELECT o.o_orderkey, o.k, c.c_nationkey
FROM (SELECT *, CASE WHEN o_custkey % 4 = 0 THEN 1 ELSE o_custkey END AS k FROM orders) o
JOIN customer c ON c.c_custkey = o.k"""


def _customers(spark, folder):
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), "c_nationkey")


@query("join_sort_merge", """
SELECT o_orderkey, o_custkey, l_linenumber, l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def join_sort_merge(spark, folder):
    items = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return ops.join_smj(items, orders, "o_orderkey").select("o_orderkey", "o_custkey", "l_linenumber", "l_partkey")


@query("join_shuffle_hash", """
SELECT o_orderkey, o_custkey, c_nationkey FROM orders JOIN customer ON c_custkey = o_custkey""")
def join_shuffle_hash(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return ops.join_hash(orders, customers, "o_custkey").select("o_orderkey", "o_custkey", "c_nationkey")


@query("join_broadcast", """
SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey""")
def join_broadcast(spark, folder):
    nation = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    places = ops.join_bcast(nation, region, "n_regionkey")
    return ops.join_bcast(table(spark, folder, "customer"), places, "c_nationkey").select("c_custkey", "n_name", "r_name")


@query("join_skewed", SKEWED_SQL)
def join_skewed(spark, folder):
    orders = skewed(spark, folder).select("o_orderkey", "k")
    return ops.join_smj(orders, _customers(spark, folder), "k").select("o_orderkey", "k", "c_nationkey")


@query("join_salted", SKEWED_SQL)
def join_salted(spark, folder):
    orders = skewed(spark, folder).select("o_orderkey", "k")
    return ops.join_salted(orders, _customers(spark, folder), "k").select("o_orderkey", "k", "c_nationkey")


@query("join_cartesian3", """
SELECT p AS priority, f AS flag, e AS event, a.n * b.n * c.n AS n
FROM (SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1) a,
     (SELECT l_returnflag AS f, count(*) AS n FROM lineitem GROUP BY 1) b,
     (SELECT event_type AS e, count(*) AS n FROM events GROUP BY 1) c""")
def join_cartesian3(spark, folder):
    inputs = [
        table(spark, folder, "orders").select("o_orderpriority"),
        table(spark, folder, "lineitem").select("l_returnflag"),
        table(spark, folder, "events").select("event_type"),
    ]
    return ops.cross(inputs, ["priority", "flag", "event"])


@query("join_left_semi_ids", f"""
WITH {LEDGER_SQL} SELECT l_orderkey, l_linenumber, attempt FROM ledger WHERE attempt <= 5""")
def join_left_semi_ids(spark, folder):
    rows = ledger(spark, folder)
    kept = ops.keep_ids(rows.select("l_orderkey", "l_linenumber", "attempt"), accepted(rows), "attempt")
    return kept.select("l_orderkey", "l_linenumber", "attempt")


@query("join_left_anti_missing", """
SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def join_left_anti_missing(spark, folder):
    received = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return ops.missing(table(spark, folder, "orders"), received, "o_orderkey")


@query("join_orphans", """
SELECT c_custkey, c_nationkey FROM customer 
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def join_orphans(spark, folder):
    urgent = table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    live = urgent.select(F.col("o_custkey").alias("c_custkey"))
    return ops.orphans(table(spark, folder, "customer").select("c_custkey", "c_nationkey"), live, "c_custkey")


@query("cogroup_merge", """
WITH merged AS (
  SELECT o_custkey AS k, o_orderkey AS v FROM orders UNION ALL SELECT c_custkey, c_nationkey FROM customer
  UNION ALL SELECT user_id, event_id FROM events),
placed AS (SELECT *, (row_number() OVER (PARTITION BY k ORDER BY v) - 1) // 50 AS page FROM merged)
SELECT k, CAST(page AS BIGINT) AS page, string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) AS vals FROM placed GROUP BY k, page""")
def cogroup_merge(spark, folder):
    inputs = [
        table(spark, folder, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v")),
        table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("long").alias("v")),
        table(spark, folder, "events").select(F.col("user_id").alias("k"), F.col("event_id").alias("v")),
    ]
    pages = ops.cogroup_n(inputs, "k", "v", 50)
    return pages.select("k", "page", F.concat_ws(",", F.col("values").cast("array<string>")).alias("vals"))
