"""Tables derived from the test data, in DataFrame form and as SQL text for the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import table

# A total order of lineitem: full rows are unique, shorter keys are not.
LEDGER_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
ORDER_SQL = ", ".join(LEDGER_ORDER)

LEDGER_SQL = """ledger AS (
  SELECT *, l_orderkey % 16 AS g, l_suppkey % 8 AS attempt, CAST(l_quantity AS BIGINT) AS len,
         l_linenumber % 3 AS replica, CASE l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS tier,
         l_linestatus = 'O' AS ok
  FROM lineitem)"""

LINES_SQL = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"

TOKENS_SQL = LINES_SQL + """, tokens AS (
  SELECT doc_id, unnest(CASE WHEN line <> '' AND rtrim(line, ' ') = '' THEN CAST([] AS VARCHAR[])
                             ELSE string_split(rtrim(line, ' '), ' ') END) AS token
  FROM lines)"""

HEARTBEATS_SQL = """heartbeats AS (
  SELECT user_id, date_trunc('second', ts) AS ts,
         CASE WHEN event_type = 'error' THEN 'UNHEALTHY' ELSE 'ACTIVE' END AS status
  FROM events)"""


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "*",
        (F.col("l_orderkey") % 16).alias("g"),
        (F.col("l_suppkey") % 8).alias("attempt"),
        F.col("l_quantity").cast("long").alias("len"),
        (F.col("l_linenumber") % 3).alias("replica"),
        F.when(F.col("l_returnflag") == "N", 1).when(F.col("l_returnflag") == "A", 2).otherwise(3).alias("tier"),
        (F.col("l_linestatus") == "O").alias("ok"),
    )


def accepted(df: DataFrame) -> DataFrame:
    """Attempts 0 to 5 of those that occur."""
    return df.select("attempt").distinct().where(F.col("attempt") <= 5)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))


def skewed(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose key k is 1 for a quarter of the customers."""
    orders = table(spark, folder, "orders")
    return orders.withColumn("k", F.when(F.col("o_custkey") % 4 == 0, F.lit(1)).otherwise(F.col("o_custkey")))


def seconds(ts: str | Column) -> Column:
    """A zoneless timestamp cut to seconds, as a timestamp in the session's zone."""
    return F.date_trunc("second", F.col(ts) if isinstance(ts, str) else ts).cast("timestamp")


def beats(events: DataFrame) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "UNHEALTHY").otherwise("ACTIVE")
    return events.select("user_id", seconds("ts").alias("ts"), status.alias("status"))


def heartbeats(spark: SparkSession, folder: str) -> DataFrame:
    return beats(table(spark, folder, "events"))


def sizes(spark: SparkSession, folder: str) -> DataFrame:
    return ledger(spark, folder).groupBy("l_suppkey").agg(F.sum("len").alias("size"))


def text_of(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
