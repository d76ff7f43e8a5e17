"""Queries over aggregations."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from millrace.operators import aggregates as ops
from millrace.operators import hooks, idsets, reduce
from millrace.plans.registry import query
from millrace.plans.views import LEDGER_SQL, TOKENS_SQL, ledger, lines
from millrace.session import ship_with_tasks
from millrace.sources import table

ship_with_tasks(__name__)


@query("agg_count_by_key", """
SELECT event_type, count(value) AS n FROM events GROUP BY event_type ORDER BY event_type""")
def agg_count_by_key(spark, folder):
    return ops.count_by(table(spark, folder, "events"), "event_type", "value")


@query("agg_word_count", f"WITH {TOKENS_SQL} SELECT token AS word, count(*) AS n FROM tokens GROUP BY token ORDER BY token")
def agg_word_count(spark, folder):
    return ops.word_count(lines(spark, folder), "line")


@query("agg_combine_by_key", """
SELECT l_suppkey, count(l_linenumber) AS n, CAST(sum(l_linenumber) AS BIGINT) AS total,
       CAST(sum(l_linenumber) AS DOUBLE) / count(l_linenumber) AS mean
FROM lineitem GROUP BY l_suppkey""")
def agg_combine_by_key(spark, folder):
    return ops.combine_by_key(table(spark, folder, "lineitem"), "l_suppkey", "l_linenumber")


@query("agg_group_by_key", """
WITH placed AS (
  SELECT l_suppkey, l_orderkey, (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) - 1) // 100 AS page
  FROM lineitem)
SELECT l_suppkey, CAST(page AS BIGINT) AS page, string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY l_orderkey) AS vals
FROM placed GROUP BY l_suppkey, page""")
def agg_group_by_key(spark, folder):
    pages = ops.group_by_key(table(spark, folder, "lineitem"), "l_suppkey", "l_orderkey", 100)
    return pages.select("l_suppkey", "page", F.concat_ws(",", F.col("values").cast("array<string>")).alias("vals"))


@query("agg_partial_final", """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
       min(l_orderkey) AS lo, max(l_orderkey) AS hi
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_partial_final(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("qty"),
        F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi"),
    )


def _spread(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.groupby("user_id", as_index=False, dropna=False).agg(n=("n", "sum"), lo=("lo", "min"), hi=("hi", "max"))


@query("agg_merge_combine", """
SELECT user_id, count(*) AS n, min(event_id) AS lo, max(event_id) AS hi FROM events GROUP BY user_id""")
def agg_merge_combine(spark, folder):
    key = F.col("event_id")
    rows = table(spark, folder, "events").select("user_id", F.lit(1).cast("long").alias("n"), key.alias("lo"), key.alias("hi"))
    return ops.combine_runs(rows, "user_id", "user_id long, n long, lo long, hi long", _spread)


def _two_largest(rows: pd.DataFrame) -> pd.DataFrame:
    """The two largest distinct values of each user, one row each, in columns."""
    seconds = rows.loc[rows["second"].notna(), ["user_id", "second"]].set_axis(["user_id", "top"], axis=1)
    values = pd.concat([rows.loc[rows["top"].notna(), ["user_id", "top"]], seconds.astype({"top": "float64"})])
    ranked = values.drop_duplicates().sort_values(["user_id", "top"], ascending=[True, False], ignore_index=True)
    user = ranked["user_id"]
    # A row follows another of its user, null users too.
    follows = (user == user.shift()) | (user.isna() & user.shift().isna() & (ranked.index > 0))
    below = ranked["top"].shift(-1).where(follows.shift(-1, fill_value=False))
    return ranked.assign(second=below.astype("float64"))[~follows].reset_index(drop=True)


@query("agg_second_largest", """
SELECT user_id, max(v) AS second FROM (
  SELECT user_id, CAST(event_id % 97 AS DOUBLE) AS v, max(CAST(event_id % 97 AS DOUBLE)) OVER (PARTITION BY user_id) AS top FROM events)
WHERE v < top GROUP BY user_id""")
def agg_second_largest(spark, folder):
    rows = table(spark, folder, "events").select("user_id", (F.col("event_id") % 97).cast("double").alias("v"))
    found = reduce.aggregate(
        rows, "user_id", "user_id long, top double, second double", "user_id long, second double",
        partial=lambda batch: _two_largest(batch.rename(columns={"v": "top"}).assign(second=None)),
        merge=_two_largest, finish=lambda states: states[["user_id", "second"]],
    )
    return found.where("second is not null")


@query("agg_null_keys", """
SELECT coalesce(k, 'null') AS k, count(*) AS n_rows, count(v) AS n, CAST(sum(v) AS BIGINT) AS total
FROM (SELECT nullif(l_returnflag, 'R') AS k, nullif(l_linenumber, 1) AS v FROM lineitem) GROUP BY k""")
def agg_null_keys(spark, folder):
    pairs = table(spark, folder, "lineitem").select(
        F.expr("nullif(l_returnflag, 'R')").alias("k"), F.expr("nullif(l_linenumber, 1)").alias("v")
    )
    out = pairs.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"), F.count("v").alias("n"), F.sum("v").alias("total"))
    return out.withColumn("k", F.coalesce("k", F.lit("null")))


@query("agg_distinct_ids", "SELECT DISTINCT l_partkey FROM lineitem")
def agg_distinct_ids(spark, folder):
    return ops.distinct_ids(table(spark, folder, "lineitem"), "l_partkey")


@query("agg_distinct_count", "SELECT count(DISTINCT l_partkey) AS n FROM lineitem")
def agg_distinct_count(spark, folder):
    return ops.count_ids(table(spark, folder, "lineitem"), "l_partkey")


@query("agg_distinct_dense", "SELECT count(DISTINCT l_partkey) AS n FROM lineitem")
def agg_distinct_dense(spark, folder):
    return ops.count_dense_ids(table(spark, folder, "lineitem"), "l_partkey")


@query("agg_ids_by_group_dense", f"""
WITH {LEDGER_SQL}, ids AS (SELECT DISTINCT g, attempt FROM ledger)
SELECT s.g, coalesce(ids.attempt, -1) AS attempt FROM (SELECT unnest(range(4, 40)) AS g) s LEFT JOIN ids ON ids.g = s.g""")
def agg_ids_by_group_dense(spark, folder):
    return ops.ids_by_group(ledger(spark, folder), "g", "attempt", 4, 40).fillna({"attempt": -1})


@query("agg_ids_bitmaps", f"WITH {LEDGER_SQL} SELECT attempt, count(DISTINCT l_partkey) AS n FROM ledger GROUP BY attempt")
def agg_ids_bitmaps(spark, folder):
    return idsets.cardinality(idsets.bitmaps(ledger(spark, folder), ["attempt"], "l_partkey"), ["attempt"])


@query("agg_ids_hash_sharded", f"WITH {LEDGER_SQL} SELECT DISTINCT g % 5 AS shard, g, attempt FROM ledger")
def agg_ids_hash_sharded(spark, folder):
    return ops.shard_ids(ledger(spark, folder), "g", "attempt", 5)


@query("agg_ids_from_shard", f"""
WITH {LEDGER_SQL} SELECT DISTINCT g, l_suppkey FROM ledger
WHERE g IN (SELECT o_orderkey % 16 FROM orders WHERE o_orderstatus = 'P')""")
def agg_ids_from_shard(spark, folder):
    sharded = ops.shard_ids(ledger(spark, folder), "g", "l_suppkey", 5)
    wanted = table(spark, folder, "orders").where("o_orderstatus = 'P'").select((F.col("o_orderkey") % 16).alias("g"))
    return ops.ids_of_groups(sharded, "g", "l_suppkey", wanted, 5)


@query("agg_invert_mapping", """
SELECT DISTINCT source, l_partkey FROM (
  SELECT unnest([l_suppkey, l_suppkey + 1, l_suppkey // 2]) AS source, l_partkey FROM lineitem)""")
def agg_invert_mapping(spark, folder):
    key = F.col("l_suppkey")
    rows = table(spark, folder, "lineitem").select(
        "l_partkey", F.array(key, key + 1, F.expr("l_suppkey div 2")).alias("sources")
    )
    return ops.invert(rows, "l_partkey", "sources")


@query("agg_group_sizes", f"""
WITH {LEDGER_SQL}
SELECT coalesce(g, -1) AS g, CAST(sum(len) AS BIGINT) AS total, count(*) AS n, CAST(grouping(g) AS INTEGER) AS is_total
FROM ledger GROUP BY ROLLUP (g)""")
def agg_group_sizes(spark, folder):
    return ops.group_sizes(ledger(spark, folder), "g", F.col("len")).fillna({"g": -1})


@query("agg_huge_groups", f"""
WITH {LEDGER_SQL}
SELECT l_suppkey % 10 AS owner, l_suppkey, CAST(sum(len) AS BIGINT) AS total FROM ledger
GROUP BY 1, 2 HAVING sum(len) > 15300""")
def agg_huge_groups(spark, folder):
    rows = ledger(spark, folder).withColumn("owner", F.col("l_suppkey") % 10)
    return ops.huge_groups(rows, "owner", "l_suppkey", F.col("len"), 15300)


@query("agg_huge_group_counts", f"""
WITH {LEDGER_SQL}, huge AS (SELECT l_suppkey % 10 AS owner, l_suppkey FROM ledger GROUP BY 1, 2 HAVING sum(len) > 15300)
SELECT count(*) AS groups, count(DISTINCT owner) AS owners FROM huge""")
def agg_huge_group_counts(spark, folder):
    rows = ledger(spark, folder).withColumn("owner", F.col("l_suppkey") % 10)
    return ops.huge_group_counts(ops.huge_groups(rows, "owner", "l_suppkey", F.col("len"), 15300), "owner")


@query("agg_quorum", f"""
WITH {LEDGER_SQL}
SELECT l_orderkey, count(DISTINCT CASE WHEN ok THEN replica END) AS successes,
       CASE WHEN count(DISTINCT CASE WHEN ok THEN replica END) >= 2 THEN 1 ELSE 0 END AS good
FROM ledger GROUP BY l_orderkey""")
def agg_quorum(spark, folder):
    out = ops.quorum(ledger(spark, folder), "l_orderkey", "replica", F.col("ok"), 3, 2, 2)
    return out.withColumn("good", F.col("good").cast("int"))


_READ_SQL = f"""
WITH {LEDGER_SQL}, sources AS (
  SELECT l_orderkey, replica, row_number() OVER (PARTITION BY l_orderkey ORDER BY replica) AS rn
  FROM (SELECT DISTINCT l_orderkey, replica FROM ledger)),
answers AS (SELECT l_orderkey, count(*) AS answers FROM sources WHERE rn <= 2 GROUP BY l_orderkey)"""


@query("agg_quorum_read_union", _READ_SQL + """
SELECT DISTINCT l.l_orderkey, l.l_partkey FROM ledger l JOIN sources s USING (l_orderkey, replica)
JOIN answers a USING (l_orderkey) WHERE s.rn <= 2 AND a.answers = 2""")
def agg_quorum_read_union(spark, folder):
    return ops.quorum_read(ledger(spark, folder), "l_orderkey", "replica", "l_partkey", 2)[0]


@query("agg_quorum_read_failed", _READ_SQL + " SELECT l_orderkey, answers FROM answers WHERE answers < 2")
def agg_quorum_read_failed(spark, folder):
    return ops.quorum_read(ledger(spark, folder), "l_orderkey", "replica", "l_partkey", 2)[1]


@query("agg_size_histogram", f"""
WITH {LEDGER_SQL}
SELECT CASE WHEN len < 10 THEN 1 WHEN len < 20 THEN 2 WHEN len < 40 THEN 3 ELSE 4 END AS band, count(*) AS n,
       CAST(sum(CASE WHEN l_linenumber > 5 THEN 1 ELSE 0 END) AS BIGINT) AS slow
FROM ledger GROUP BY 1""")
def agg_size_histogram(spark, folder):
    return ops.size_bands(ledger(spark, folder), F.col("len"), F.col("l_linenumber"), 10, 20, 40, 5)


@query("agg_read_skip_stats", f"""
WITH {LEDGER_SQL}
SELECT tier, count(*) FILTER (WHERE ok) AS read_rows, CAST(sum(CASE WHEN ok THEN len ELSE 0 END) AS BIGINT) AS read_bytes,
       CAST(sum(CASE WHEN ok THEN l_partkey ELSE 0 END) AS BIGINT) AS read_raw_bytes,
       count(*) FILTER (WHERE NOT ok) AS skipped_rows,
       CAST(sum(CASE WHEN ok THEN 0 ELSE len END) AS BIGINT) AS skipped_bytes,
       CAST(sum(CASE WHEN ok THEN 0 ELSE l_partkey END) AS BIGINT) AS skipped_raw_bytes
FROM ledger GROUP BY tier""")
def agg_read_skip_stats(spark, folder):
    return ops.read_stats(ledger(spark, folder), "tier", F.col("ok"), F.col("len"), F.col("l_partkey"))


@query("agg_health_pct", """
WITH m AS (SELECT *, c_mktsegment = 'MACHINERY' AND c_acctbal < 1000 AS bad FROM customer)
SELECT c_nationkey, count(*) AS members, count(*) FILTER (WHERE c_acctbal >= 0 AND NOT bad) AS good,
       count(*) FILTER (WHERE bad) AS corrupt,
       CAST(sum(CASE WHEN bad THEN 0 ELSE c_custkey END) AS BIGINT) AS used,
       CAST(sum(CASE WHEN bad THEN 0 ELSE c_custkey * 2 END) AS BIGINT) AS space,
       CASE WHEN count(*) FILTER (WHERE c_acctbal >= 0 AND NOT bad) * 100.0 / count(*) >= 90 THEN 1 ELSE 0 END AS healthy
FROM m GROUP BY c_nationkey""")
def agg_health_pct(spark, folder):
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    corrupt = (F.col("c_mktsegment") == "MACHINERY") & (balance < 1000)
    out = ops.health(table(spark, folder, "customer"), "c_nationkey", balance >= 0, key, key * 2, 90, corrupt)
    return out.withColumn("healthy", F.col("healthy").cast("int"))


@query("agg_entities_per_owner", """
SELECT c_nationkey, count(DISTINCT c_custkey) AS n FROM customer GROUP BY c_nationkey""")
def agg_entities_per_owner(spark, folder):
    return ops.per_owner(table(spark, folder, "customer"), "c_nationkey", "c_custkey")


@query("agg_commit_complete", """
SELECT CAST(day(ts) AS INTEGER) AS d, count(DISTINCT user_id) AS reported,
       CASE WHEN count(DISTINCT user_id) = (SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'purchase')
            THEN 1 ELSE 0 END AS complete
FROM events GROUP BY 1""")
def agg_commit_complete(spark, folder):
    events = table(spark, folder, "events")
    expected = ops.count_ids(events.where("event_type = 'purchase'"), "user_id").first()[0]
    out = ops.commit_complete(events.withColumn("d", F.dayofmonth("ts")), "d", "user_id", expected)
    return out.withColumn("complete", F.col("complete").cast("int"))


def _words(rows: pd.DataFrame) -> pd.DataFrame:
    """Words of a batch of lines by pandas, under the rule of ``functions.text.tokens``."""
    body = rows["line"].str.rstrip(" ")
    blank = (rows["line"] != "") & (body == "")
    return pd.DataFrame({"word": body[~blank].str.split(" ").explode()})


@query("hook_flat_map", f"WITH {TOKENS_SQL} SELECT token AS word, count(*) AS n FROM tokens GROUP BY token")
def hook_flat_map(spark, folder):
    words = hooks.flat_map(lines(spark, folder).select("line"), "word string", _words)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("hook_grouping", """
SELECT o_orderkey, o_custkey, CAST(row_number() OVER (
         PARTITION BY o_custkey // 10 ORDER BY o_orderkey % 100 DESC, o_orderkey) - 1 AS BIGINT) AS pos
FROM orders""")
def hook_grouping(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    order = [-(F.col("o_orderkey") % 100), F.col("o_orderkey")]
    return hooks.numbered_by(orders, F.expr("o_custkey div 10"), order)


@query("hook_group_heads", """
SELECT o_custkey // 10 AS block, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1""")
def hook_group_heads(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    heads = hooks.heads_by(orders, F.expr("o_custkey div 10"), [F.col("o_orderkey")])
    return heads.select(F.expr("o_custkey div 10").alias("block"), "o_orderkey")


def _drawdown(key, pages):
    """The deepest fall below an earlier value: needs the order, holds two numbers."""
    top, fall = float("-inf"), 0.0
    for page in pages:
        prices = page["o_totalprice"].to_numpy()
        highs = np.fmax.accumulate(np.append(top, prices))[1:]
        fall, top = max(fall, float(np.fmax.reduce(highs - prices))), float(np.where(np.isnan(prices[-1]), prices[-1], highs[-1]))
    yield key[0], fall


@query("hook_reduce", """
SELECT o_custkey, max(high - o_totalprice) AS fall FROM (
  SELECT o_custkey, o_totalprice, max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS high FROM orders)
GROUP BY o_custkey""")
def hook_reduce(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    return reduce.reduce_groups(orders, ["o_custkey"], ["o_orderkey"], "o_custkey long, fall double", _drawdown, page_rows=8)


def _orders_and_balance(key, orders, customers):
    n, first = 0, None
    for page in orders:
        n, first = n + len(page), int(page["o_orderkey"].iloc[0]) if first is None else first
    balance = next((float(page["c_acctbal"].iloc[0]) for page in customers), None)
    yield key[0], n, first, balance


@query("hook_reduce_pairs", """
WITH o AS (SELECT o_custkey AS k, count(*) AS n, min(o_orderkey) AS "first" FROM orders WHERE o_custkey % 3 > 0 GROUP BY 1),
c AS (SELECT c_custkey AS k, CAST(c_acctbal AS DOUBLE) AS balance FROM customer WHERE c_custkey % 3 < 2)
SELECT coalesce(o.k, c.k) AS k, coalesce(n, 0) AS n, "first", balance FROM o FULL JOIN c ON c.k = o.k""")
def hook_reduce_pairs(spark, folder):
    orders = table(spark, folder, "orders").where("o_custkey % 3 > 0").select(F.col("o_custkey").alias("k"), "o_orderkey")
    customers = table(spark, folder, "customer").where("c_custkey % 3 < 2").select(
        F.col("c_custkey").alias("k"), F.col("c_acctbal").cast("double").alias("c_acctbal")
    )
    schema = "k long, n long, first long, balance double"
    return reduce.reduce_pairs(orders, customers, ["k"], schema, _orders_and_balance, (["o_orderkey"], []), page_rows=8)


class _Runs:
    """Table function: runs of order keys at most 40 apart."""

    def __init__(self):
        self.supplier = self.start = self.stop = None
        self.n = 0

    def eval(self, row):
        if self.n and row["l_orderkey"] - self.stop > 40:
            yield self.supplier, self.start, self.stop, self.n
            self.n = 0
        if not self.n:
            self.supplier, self.start = row["l_suppkey"], row["l_orderkey"]
        self.stop, self.n = row["l_orderkey"], self.n + 1

    def terminate(self):
        if self.n:
            yield self.supplier, self.start, self.stop, self.n


@query("hook_table_function", """
WITH gaps AS (
  SELECT l_suppkey, l_orderkey,
         CASE WHEN l_orderkey - lag(l_orderkey) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) > 40 THEN 1 ELSE 0 END AS new
  FROM lineitem),
runs AS (SELECT *, sum(new) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey ROWS UNBOUNDED PRECEDING) AS run FROM gaps)
SELECT l_suppkey, min(l_orderkey) AS start, max(l_orderkey) AS stop, count(*) AS n FROM runs GROUP BY l_suppkey, run""")
def hook_table_function(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey")
    return hooks.table_function(rows, _Runs, "l_suppkey long, start long, stop long, n long", ["l_suppkey"], ["l_orderkey"])
