"""Queries over scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import functions as fn
from millrace.plans.registry import query
from millrace.sources import table

_PACKED_SQL = """packed AS (
  SELECT CAST(l_linenumber AS BIGINT) AS seq, l_partkey % 16777216 AS part, l_suppkey % 2097152 AS task,
         (CAST(l_linenumber AS BIGINT) << 45) | ((l_partkey % 16777216) << 21) | (l_suppkey % 2097152) AS id
  FROM lineitem)"""


def _packed(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.col("l_linenumber").cast("long").alias("seq"), (F.col("l_partkey") % (1 << 24)).alias("part"),
        (F.col("l_suppkey") % (1 << 21)).alias("task"),
    )
    return rows.withColumn("id", fn.pack_id(F.col("seq"), F.col("part"), F.col("task")))


@query("fn_pack_id", f"WITH {_PACKED_SQL} SELECT seq, part, task, id FROM packed")
def fn_pack_id(spark, folder):
    return _packed(spark, folder)


@query("fn_unpack_id", f"WITH {_PACKED_SQL} SELECT id, seq, part, task FROM packed")
def fn_unpack_id(spark, folder):
    return _packed(spark, folder).select("id", *[c.alias(n) for n, c in fn.unpack_id(F.col("id")).items()])


@query("fn_pack_attempt_id", """
SELECT CAST(l_linenumber AS BIGINT) AS seq, l_suppkey % 64 AS attempt,
       (((CAST(l_linenumber AS BIGINT) << 6) | (l_suppkey % 64)) << 45) | ((l_partkey % 16777216) << 21)
       | (l_suppkey % 2097152) AS id
FROM lineitem""")
def fn_pack_attempt_id(spark, folder):
    rows = table(spark, folder, "lineitem")
    packed = fn.pack_attempt_id(
        F.col("l_linenumber"), F.col("l_partkey") % (1 << 24), F.col("l_suppkey") % (1 << 21), F.col("l_suppkey") % 64
    )
    fields = fn.unpack_attempt(F.col("id"))
    return rows.select(packed.alias("id")).select(fields["seq"].alias("seq"), fields["attempt"].alias("attempt"), "id")


@query("fn_crc32", """
WITH bytes AS (
  SELECT doc_id, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b FROM documents)
SELECT doc_id, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], b), lambda c, x:
         list_reduce(list_concat([xor(c, x)], [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]), lambda a, bit: xor(a >> 1, 3988292384 * (a & 1)))),
       4294967295) AS crc
FROM bytes""")
def fn_crc32(spark, folder):
    return table(spark, folder, "documents").select("doc_id", fn.crc32(F.col("text")).alias("crc"))


@query("fn_metric_name", """
SELECT p_partkey, replace(replace(coalesce(nullif(p_brand, 'Brand#11') || '.' || p_name || '-x', ''), '.', '_'), '-', '_') AS name
FROM part""")
def fn_metric_name(spark, folder):
    text = F.concat(F.expr("nullif(p_brand, 'Brand#11')"), F.lit("."), F.col("p_name"), F.lit("-x"))
    return table(spark, folder, "part").select("p_partkey", fn.metric_name(text).alias("name"))


@query("fn_path_key", """
SELECT l_orderkey || '/' || l_linenumber || '/' || (l_partkey // 4 * 4) || '-' || (l_partkey // 4 * 4 + 3) AS path
FROM lineitem""")
def fn_path_key(spark, folder):
    p = F.col("l_partkey")
    span = fn.range_key(fn.range_start(p, 4), fn.range_end(p, 4))
    return table(spark, folder, "lineitem").select(fn.path_key(F.col("l_orderkey"), F.col("l_linenumber"), span).alias("path"))


@query("fn_format_ts", """
SELECT event_id, strftime(make_timestamp_ms(event_id % 100000 * 86400123 + 1700000000999), '%Y-%m-%d %H:%M:%S') AS text
FROM events""")
def fn_format_ts(spark, folder):
    # Milliseconds built from the id, wrapped to stay within four-digit years on large tables.
    epoch = F.col("event_id") % 100000 * 86400123 + F.lit(1700000000999)
    return table(spark, folder, "events").select("event_id", fn.fmt_ts(epoch).alias("text"))


@query("fn_range_of", """
SELECT l_partkey, CASE WHEN l_partkey < 1500 THEN l_partkey // 7 * 7 ELSE -1 END AS lo,
       CASE WHEN l_partkey < 1500 THEN l_partkey // 7 * 7 + 6 ELSE -1 END AS hi
FROM lineitem""")
def fn_range_of(spark, folder):
    start, end = fn.range_of(F.col("l_partkey"), 7, 1500)
    rows = table(spark, folder, "lineitem").select("l_partkey", start.alias("lo"), end.alias("hi"))
    return rows.fillna({"lo": -1, "hi": -1})
