"""Queries over readers and writers."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import sources as src
from millrace.operators.aggregates import word_count
from millrace.plans.registry import query
from millrace.plans.views import LEDGER_SQL, TOKENS_SQL, ledger, lines
from millrace.session import scratch_path


@query("scan_csv_schema", """
SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nation, -1 AS not_a_number, 'none' AS not_there
FROM customer""")
def scan_csv_schema(spark, folder):
    path = scratch_path(spark, "csv")
    customer = src.table(spark, folder, "customer")
    customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").write.csv(path)
    rows = src.scan_csv(spark, path, "custkey long, name string, nation int, not_a_number int, not_there string")
    return rows.fillna({"not_a_number": -1, "not_there": "none"})


@query("scan_text_lines", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def scan_text_lines(spark, folder):
    path = scratch_path(spark, "text")
    src.table(spark, folder, "documents").select(F.col("text").alias("value")).write.text(path)
    return src.scan_text(spark, path)


@query("scan_glob", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def scan_glob(spark, folder):
    return src.scan_glob(spark, folder, "ord", ".parquet", "parquet",
                         "o_orderkey long, o_custkey long, o_orderstatus string")


@query("scan_range", "SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 1, 3)) AS id FROM orders")
def scan_range(spark, folder):
    low, high = src.table(spark, folder, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return src.scan_range(spark, low, high + 1, 3)


@query("scan_empty", """
SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderkey < 0 GROUP BY o_orderstatus""")
def scan_empty(spark, folder):
    orders = src.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    nothing = src.scan_empty(spark, "o_orderkey long, o_orderstatus string")
    rows = src.read_all([orders.where("o_orderkey < 0"), nothing])
    return rows.repartition("o_orderstatus").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("scan_parquet", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity >= 30 AND l_returnflag = 'R'""")
def scan_parquet(spark, folder):
    rows = src.table(spark, folder, "lineitem").where("l_quantity >= 30 AND l_returnflag = 'R'")
    return rows.select("l_orderkey", "l_partkey", "l_quantity")


@query("sink_sorted_text", f"""
WITH {TOKENS_SQL} SELECT token || chr(9) || CAST(count(*) AS VARCHAR) AS value FROM tokens GROUP BY token""")
def sink_sorted_text(spark, folder):
    path = scratch_path(spark, "sorted")
    counted = word_count(lines(spark, folder), "line")
    src.sink_sorted_text(counted, path, F.concat_ws("\t", "word", F.col("n").cast("string")), "word")
    return src.scan_text(spark, path)


@query("sink_range_layout", """
SELECT CAST(l_orderkey % 100 // 8 * 8 AS VARCHAR) || '-' || CAST(l_orderkey % 100 // 8 * 8 + 7 AS VARCHAR) AS range,
       count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum
FROM lineitem GROUP BY 1""")
def sink_range_layout(spark, folder):
    path = scratch_path(spark, "ranges")
    rows = src.table(spark, folder, "lineitem").select("l_orderkey", (F.col("l_orderkey") % 100).alias("p"))
    src.sink_ranges(rows, "p", 8, 100, path)
    back = spark.read.schema("l_orderkey long, p long, range string").parquet(path)
    return back.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum"))


@query("route_by_size", f"""
WITH {LEDGER_SQL} SELECT l_orderkey, l_partkey, len, CASE WHEN len > 25 THEN 'cold' ELSE 'warm' END AS tier FROM ledger""")
def route_by_size(spark, folder):
    rows = ledger(spark, folder).select("l_orderkey", "l_partkey", "len")
    return src.route_by_size(rows, F.col("len"), 25)


@query("route_by_huge_group", f"""
WITH {LEDGER_SQL}, totals AS (SELECT l_suppkey, sum(len) AS total FROM ledger GROUP BY l_suppkey)
SELECT l_orderkey, l_suppkey, len, CASE WHEN total > 15300 THEN 'cold' ELSE 'warm' END AS tier
FROM ledger JOIN totals USING (l_suppkey)""")
def route_by_huge_group(spark, folder):
    rows = ledger(spark, folder).select("l_orderkey", "l_suppkey", "len")
    return src.route_huge_groups(rows, "l_suppkey", F.col("len"), 15300)


@query("sink_hash_spread", f"""
WITH {LEDGER_SQL} SELECT l_orderkey, l_linenumber, g,
       CAST(CAST('0x' || substr(md5(concat_ws('_', g, l_orderkey, l_linenumber)), 1, 15) AS BIGINT) % 7 AS INTEGER) AS sink
FROM ledger""")
def sink_hash_spread(spark, folder):
    rows = ledger(spark, folder).select("l_orderkey", "l_linenumber", "g")
    return src.hash_spread(rows, ["g", "l_orderkey", "l_linenumber"], 7)


@query("union_sources", """
SELECT c_custkey AS key, c_nationkey AS nation FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier""")
def union_sources(spark, folder):
    customer = src.table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"))
    supplier = src.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation"))
    return src.read_all([customer, supplier])


@query("sink_routed", f"""
WITH {LEDGER_SQL}
SELECT CASE WHEN len > 25 THEN 'cold' ELSE 'warm' END AS tier, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum
FROM ledger GROUP BY 1""")
def sink_routed(spark, folder):
    path = scratch_path(spark, "routed")
    rows = ledger(spark, folder).select("l_orderkey", "len")
    src.sink_routed(src.route_by_size(rows, F.col("len"), 25), path)
    back = spark.read.schema("l_orderkey long, len long, tier string").parquet(path)
    return back.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum"))
