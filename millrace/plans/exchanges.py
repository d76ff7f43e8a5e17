"""Queries over exchanges."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import exchange
from millrace.plans.registry import query
from millrace.sources import table


def _orders(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey")


@query("xchg_hash", "SELECT o_orderkey, o_custkey FROM orders")
def xchg_hash(spark, folder):
    return exchange.by_hash(_orders(spark, folder), None, "o_custkey")


def _partitions(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("xchg_round_robin", "SELECT o_orderkey, o_custkey FROM orders")
def xchg_round_robin(spark, folder):
    return exchange.evenly(_orders(spark, folder), _partitions(spark))


@query("xchg_custom_partitioner", """
SELECT l_orderkey, l_partkey, CAST(l_orderkey % 200 AS INTEGER) AS partition FROM lineitem""")
def xchg_custom_partitioner(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    placed = exchange.by_partitioner(rows, 200, F.col("l_orderkey") % 200)
    return placed.withColumn("partition", F.spark_partition_id())


@query("xchg_range", "SELECT o_orderkey, o_custkey FROM orders")
def xchg_range(spark, folder):
    return exchange.by_range(_orders(spark, folder), _partitions(spark), "o_custkey", "o_orderkey")


@query("xchg_coalesce_adaptive", "SELECT o_orderkey, o_custkey FROM orders")
def xchg_coalesce_adaptive(spark, folder):
    return exchange.adaptive(_orders(spark, folder), "o_orderkey")


@query("xchg_chain", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey")
def xchg_chain(spark, folder):
    keys = table(spark, folder, "lineitem").select("l_orderkey")
    return exchange.chained(keys, "l_orderkey", _partitions(spark), 2 * _partitions(spark))


@query("conservation_observed", "SELECT count(*) AS written, count(*) AS fetched, 1 AS same FROM orders")
def conservation_observed(spark, folder):
    out = exchange.moved(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), _partitions(spark), "o_orderkey")[1]
    return out.withColumn("same", F.col("same").cast("int"))


@query("conservation_check", """
SELECT o_orderstatus, count(*) AS written, count(*) AS fetched, 1 AS same FROM orders GROUP BY o_orderstatus""")
def conservation_check(spark, folder):
    before = table(spark, folder, "orders").select("o_orderstatus", "o_orderkey")
    after = exchange.by_hash(before, _partitions(spark), "o_orderkey")
    out = exchange.conserved(before, after, ["o_orderstatus"])
    return out.withColumn("same", F.col("same").cast("int"))
