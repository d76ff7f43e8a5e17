"""Queries over delivery audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import crc32
from millrace.operators import audit, chunking
from millrace.plans.registry import query
from millrace.plans.views import LEDGER_SQL, accepted, ledger
from millrace.session import persist_table
from millrace.sources import table


def _expected(spark, folder):
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select((key % 16).alias("g"), key.alias("l_orderkey"))


@query("audit_complete", f"""
WITH {LEDGER_SQL}
SELECT o_orderkey % 16 AS g, count(*) AS expected, count(l_orderkey) AS actual,
       CASE WHEN count(*) = count(l_orderkey) THEN 1 ELSE 0 END AS complete
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM ledger) ON l_orderkey = o_orderkey GROUP BY 1""")
def audit_complete(spark, folder):
    out = audit.audit_complete(_expected(spark, folder), ledger(spark, folder), "g", "l_orderkey")
    return out.withColumn("complete", F.col("complete").cast("int"))


@query("audit_checksum", "SELECT doc_id, lang FROM documents WHERE lang = 'de'")
def audit_checksum(spark, folder):
    # The stored checksum of German documents is off by one.
    docs = table(spark, folder, "documents")
    stored = crc32(F.col("text")) + F.when(F.col("lang") == "de", 1).otherwise(0)
    return audit.verify_crc(docs.withColumn("stored", stored), F.col("text"), F.col("stored")).select("doc_id", "lang")


@query("audit_chunk_checksum", "SELECT doc_id, lang FROM documents WHERE lang = 'de' AND length(text) > 0")
def audit_chunk_checksum(spark, folder):
    # Texts are packed with their checksums; then the bytes of the German chunks change, the checksums stay.
    docs = table(spark, folder, "documents").select("lang", "doc_id", F.encode("text", "UTF-8").alias("body"))
    packed = persist_table(chunking.pack(docs, ["lang"], ["doc_id"], "doc_id", "body", 50_000), "packed")
    other = F.unhex(F.translate(F.hex("payload"), "0123456789ABCDEF", "123456789ABCDEF0"))
    damaged = packed.withColumn("payload", F.when(F.col("lang") == "de", other).otherwise(F.col("payload")))
    return chunking.unpack(damaged).where(~F.col("ok")).select(F.col("id").alias("doc_id"), "lang")


@query("audit_delivery", f"""
WITH {LEDGER_SQL}, kept AS (SELECT * FROM ledger WHERE attempt <= 5),
damaged AS (SELECT g, count(*) AS damaged FROM kept WHERE NOT ok GROUP BY g),
verdict AS (
  SELECT o_orderkey % 16 AS g, count(*) AS expected, count(l_orderkey) AS actual
  FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM kept WHERE ok) ON l_orderkey = o_orderkey GROUP BY 1)
SELECT v.g, expected, actual, CASE WHEN expected = actual THEN 1 ELSE 0 END AS complete, coalesce(damaged, 0) AS damaged
FROM verdict v LEFT JOIN damaged d ON d.g = v.g""")
def audit_delivery(spark, folder):
    rows = ledger(spark, folder)
    out = audit.audit_delivery(rows, _expected(spark, folder), accepted(rows), "g", "l_orderkey", "attempt", F.col("ok"))
    return out.withColumn("complete", F.col("complete").cast("int"))


@query("audit_retry_threshold", """
WITH failures AS (
  SELECT user_id % 5 AS parent, user_id, CAST(day(ts) AS INTEGER) AS attempt FROM events WHERE event_type = 'error'),
newest AS (SELECT parent, max(attempt) AS attempt FROM failures GROUP BY parent)
SELECT parent, user_id, attempt, count(*) AS failures, CASE WHEN count(*) >= 2 THEN 1 ELSE 0 END AS flagged
FROM failures JOIN newest USING (parent, attempt) GROUP BY parent, user_id, attempt""")
def audit_retry_threshold(spark, folder):
    events = table(spark, folder, "events").where("event_type = 'error'")
    failures = events.select((F.col("user_id") % 5).alias("parent"), "user_id", F.dayofmonth("ts").alias("attempt"))
    out = audit.retry_flags(failures, "parent", "user_id", "attempt", 2)
    return out.withColumn("flagged", F.col("flagged").cast("int"))
