"""Queries over sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import idsets, sets, sorts
from millrace.plans.registry import query
from millrace.plans.views import LEDGER_ORDER, LEDGER_SQL, ORDER_SQL, TOKENS_SQL, ledger, lines, sizes
from millrace.sources import table


@query("sort_global", f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY {ORDER_SQL}")
def sort_global(spark, folder):
    return sorts.sort_global(table(spark, folder, "lineitem"), *LEDGER_ORDER).select("l_orderkey", "l_linenumber", "l_partkey")


@query("sort_secondary", f"WITH {LEDGER_SQL} SELECT g, l_orderkey FROM ledger ORDER BY g, l_orderkey")
def sort_secondary(spark, folder):
    return sorts.secondary_sort(ledger(spark, folder).select("g", "l_orderkey"), "g", "l_orderkey")


@query("sort_secondary_position", f"""
WITH {LEDGER_SQL} SELECT g, l_orderkey, CAST(row_number() OVER (PARTITION BY g ORDER BY l_orderkey) - 1 AS BIGINT) AS pos
FROM ledger""")
def sort_secondary_position(spark, folder):
    return sorts.position_in_group(ledger(spark, folder).select("g", "l_orderkey"), "g", ["l_orderkey"])


@query("sort_by_count", f"WITH {TOKENS_SQL} SELECT token AS word, count(*) AS n FROM tokens GROUP BY token ORDER BY n, word")
def sort_by_count(spark, folder):
    return sorts.ordered_count(lines(spark, folder), "line")


@query("sort_within_partition", f"""
WITH {LEDGER_SQL}, placed AS (SELECT *, l_orderkey % 200 AS p FROM ledger)
SELECT p, attempt, l_orderkey, l_partkey,
       CAST(row_number() OVER (PARTITION BY p ORDER BY attempt, {ORDER_SQL}) - 1 AS BIGINT) AS pos
FROM placed""")
def sort_within_partition(spark, folder):
    rows = ledger(spark, folder).withColumn("p", F.col("l_orderkey") % 200)
    placed = sorts.local_sort(rows, F.col("p"), 200, "attempt", *LEDGER_ORDER)
    return placed.select("p", "attempt", "l_orderkey", "l_partkey", sorts.local_position().alias("pos"))


@query("topk_largest", f"""
WITH {LEDGER_SQL} SELECT l_suppkey, CAST(sum(len) AS BIGINT) AS size FROM ledger GROUP BY l_suppkey
ORDER BY size DESC, l_suppkey LIMIT 25""")
def topk_largest(spark, folder):
    return sorts.largest(sizes(spark, folder), "size", 25, "l_suppkey")


def _ids(spark, folder, name, column):
    return table(spark, folder, name).select(F.col(column).alias("id"))


@query("set_union_distinct", """
SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer UNION SELECT user_id FROM events""")
def set_union_distinct(spark, folder):
    return sets.union_set([
        _ids(spark, folder, "orders", "o_custkey"), _ids(spark, folder, "customer", "c_custkey"),
        _ids(spark, folder, "events", "user_id"),
    ])


@query("set_union_bitmaps", """
SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer UNION SELECT user_id FROM events""")
def set_union_bitmaps(spark, folder):
    return idsets.union_distinct([
        _ids(spark, folder, "orders", "o_custkey"), _ids(spark, folder, "customer", "c_custkey"),
        _ids(spark, folder, "events", "user_id"),
    ], "id")


@query("set_union_all", """
SELECT o_custkey AS id FROM orders UNION ALL SELECT c_custkey FROM customer UNION ALL SELECT user_id FROM events""")
def set_union_all(spark, folder):
    return sets.union_bag([
        _ids(spark, folder, "orders", "o_custkey"), _ids(spark, folder, "customer", "c_custkey"),
        _ids(spark, folder, "events", "user_id"),
    ])


@query("set_intersect", "SELECT o_orderkey AS id FROM orders INTERSECT SELECT l_orderkey FROM lineitem")
def set_intersect(spark, folder):
    return sets.intersect_ids(_ids(spark, folder, "orders", "o_orderkey"), _ids(spark, folder, "lineitem", "l_orderkey"))


@query("set_except", "SELECT o_orderkey AS id FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def set_except(spark, folder):
    return sets.except_ids(_ids(spark, folder, "orders", "o_orderkey"), _ids(spark, folder, "lineitem", "l_orderkey"))


@query("dataset_diff", """
SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b
FROM (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) a
FULL JOIN (SELECT l_orderkey AS k, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY 1) b
ON a.k = b.k WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def dataset_diff(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    once = items.distinct()
    return sets.diff(items.select(F.col("l_orderkey").alias("k")), once.select(F.col("l_orderkey").alias("k")))
