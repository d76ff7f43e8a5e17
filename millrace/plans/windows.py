"""Queries over ordered scans, chunking, picking and placement."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import chunking, ordered, picking, placement
from millrace.plans.registry import query
from millrace.plans.views import LEDGER_ORDER, LEDGER_SQL, ORDER_SQL, ledger, sizes
from millrace.sources import table

SEQ_SQL = f"""{LEDGER_SQL}, seq AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY {ORDER_SQL}) AS rn,
         sum(len) OVER (PARTITION BY g ORDER BY {ORDER_SQL} ROWS UNBOUNDED PRECEDING) AS upto
  FROM ledger)"""


@query("win_sequence_no", f"WITH {SEQ_SQL} SELECT g, l_orderkey, l_linenumber, l_partkey, CAST(rn - 1 AS BIGINT) AS seq FROM seq")
def win_sequence_no(spark, folder):
    rows = ordered.row_index(ledger(spark, folder), ["g"], LEDGER_ORDER, "seq")
    return rows.select("g", "l_orderkey", "l_linenumber", "l_partkey", "seq")


@query("win_running_offset", f"""
WITH {SEQ_SQL} SELECT g, l_orderkey, l_linenumber, len, CAST(upto - len AS BIGINT) AS "offset" FROM seq""")
def win_running_offset(spark, folder):
    rows = ordered.start_offset(ledger(spark, folder), ["g"], LEDGER_ORDER, F.col("len"))
    return rows.select("g", "l_orderkey", "l_linenumber", "len", "offset")


@query("win_truncate_to_length", f"""
WITH {SEQ_SQL}, declared AS (SELECT g, CASE WHEN g % 4 = 1 THEN -1 ELSE sum(len) // 2 END AS total FROM ledger GROUP BY g)
SELECT g, l_orderkey, l_linenumber, len FROM seq JOIN declared USING (g) WHERE total = -1 OR upto <= total""")
def win_truncate_to_length(spark, folder):
    rows = ledger(spark, folder)
    declared = rows.groupBy("g").agg(F.sum("len").alias("_all"))
    declared = declared.select("g", F.expr("CASE WHEN g % 4 = 1 THEN -1 ELSE _all div 2 END").alias("total"))
    kept = ordered.truncate_to(rows.join(declared, "g"), ["g"], LEDGER_ORDER, F.col("len"), F.col("total"))
    return kept.select("g", "l_orderkey", "l_linenumber", "len")


def _chunk_columns(chunks):
    members = F.concat_ws(",", F.col("members").cast("array<string>"))
    return chunks.select("g", "offset", "total", "n", members.alias("members"))


def _recursive_sql(rows: str, keys: str, limit: int, closes: str) -> str:
    """Greedy chunks row by row; ``rows`` has the keys, ``pos`` from 1, ``start``, len and l_orderkey."""
    same = " AND ".join(f"s.{k} = c.{k}" for k in keys.split(", "))
    of = ", ".join(f"s.{k}" for k in keys.split(", "))
    return f"""{rows}, walk AS (
  SELECT {keys}, pos, start, len AS acc, l_orderkey FROM steps WHERE pos = 1
  UNION ALL
  SELECT {of}, s.pos, CASE WHEN c.acc {closes} {limit} THEN s.start ELSE c.start END,
         CASE WHEN c.acc {closes} {limit} THEN s.len ELSE c.acc + s.len END, s.l_orderkey
  FROM walk c JOIN steps s ON {same} AND s.pos = c.pos + 1)
SELECT g, CAST(start AS BIGINT) AS "offset", CAST(max(acc) AS BIGINT) AS total, count(*) AS n,
       string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY pos) AS members
FROM walk GROUP BY {keys}, start"""


_STEPS_SQL = f"""WITH RECURSIVE {SEQ_SQL},
steps AS MATERIALIZED (SELECT g, rn AS pos, upto - len AS start, len, l_orderkey FROM seq)"""


@query("win_chunk_by_size", _recursive_sql(_STEPS_SQL, "g", 200, ">="))
def win_chunk_by_size(spark, folder):
    return _chunk_columns(chunking.chunk(ledger(spark, folder), ["g"], LEDGER_ORDER, F.col("len"), 200, "l_orderkey"))


@query("win_chunk_by_size_strict", _recursive_sql(_STEPS_SQL, "g", 300, ">"))
def win_chunk_by_size_strict(spark, folder):
    rows = ledger(spark, folder)
    return _chunk_columns(chunking.chunk(rows, ["g"], LEDGER_ORDER, F.col("len"), 300, "l_orderkey", strict=True))


_WALK_SQL = _recursive_sql(_STEPS_SQL, "g", 200, ">=").split("SELECT g, CAST(start AS BIGINT)")[0]


@query("win_chunk_members", f"""{_WALK_SQL}
SELECT w.g, CAST(w.start AS BIGINT) AS "offset", CAST(max(acc) AS BIGINT) AS total,
       string_agg(w.l_orderkey || ':' || CAST(acc - s.len AS BIGINT) || ':' || s.len, ',' ORDER BY w.pos) AS members
FROM walk w JOIN steps s ON s.g = w.g AND s.pos = w.pos GROUP BY w.g, w.start""")
def win_chunk_members(spark, folder):
    rows = ledger(spark, folder)
    chunks = chunking.chunk(rows, ["g"], LEDGER_ORDER, F.col("len"), 200, "l_orderkey", carry={"line": F.col("l_linenumber")})
    placed = F.transform("members", lambda m: F.concat_ws(":", *[m[f].cast("string") for f in ("id", "offset", "length")]))
    return chunks.select("g", "offset", "total", F.array_join(placed, ",").alias("members"))


@query("win_chunk_cut_apart", f"""
WITH {SEQ_SQL} SELECT g, l_orderkey AS id, CAST(upto - len AS BIGINT) AS "offset", len AS length, l_linenumber AS line FROM seq""")
def win_chunk_cut_apart(spark, folder):
    rows = ledger(spark, folder)
    chunks = chunking.chunk(rows, ["g"], LEDGER_ORDER, F.col("len"), 200, "l_orderkey", carry={"line": F.col("l_linenumber")}, page_rows=16)
    return chunking.cut_apart(chunks)


@query("win_chunk_unpack", """
SELECT lang, doc_id AS id, md5(coalesce(text, '')) AS digest, 1 AS ok FROM documents""")
def win_chunk_unpack(spark, folder):
    docs = table(spark, folder, "documents").select("lang", "doc_id", F.encode("text", "UTF-8").alias("body"))
    back = chunking.unpack(chunking.pack(docs, ["lang"], ["doc_id"], "doc_id", "body", 100_000))
    return back.select("lang", "id", F.md5("payload").alias("digest"), F.col("ok").cast("int").alias("ok"))


@query("win_chunk_islands", _recursive_sql(f"""WITH RECURSIVE {SEQ_SQL},
kept AS (SELECT *, rn - row_number() OVER (PARTITION BY g ORDER BY rn) AS island FROM seq WHERE attempt <= 5),
steps AS MATERIALIZED (
  SELECT g, island, row_number() OVER (PARTITION BY g, island ORDER BY rn) AS pos, upto - len AS start, len, l_orderkey
  FROM kept)""", "g, island", 60, ">="))
def win_chunk_islands(spark, folder):
    rows = ledger(spark, folder)
    chunks = chunking.chunk_islands(rows, ["g"], LEDGER_ORDER, F.col("len"), 60, F.col("attempt") <= 5, "l_orderkey")
    return _chunk_columns(chunks)


@query("win_merge_ranges", f"""
WITH RECURSIVE {SEQ_SQL}, steps AS MATERIALIZED (
  SELECT g, row_number() OVER (PARTITION BY g ORDER BY rn) AS pos, upto - len AS off, upto AS stop FROM seq
  WHERE attempt <= 5),
walk AS (
  SELECT g, pos, off AS start, stop FROM steps WHERE pos = 1
  UNION ALL
  SELECT s.g, s.pos, CASE WHEN c.stop - c.start >= 400 OR s.off - c.stop > 200 THEN s.off ELSE c.start END, s.stop
  FROM walk c JOIN steps s ON s.g = c.g AND s.pos = c.pos + 1)
SELECT g, CAST(start AS BIGINT) AS "offset", CAST(max(stop) - start AS BIGINT) AS total, count(*) AS n
FROM walk GROUP BY g, start""")
def win_merge_ranges(spark, folder):
    extents = ordered.start_offset(ledger(spark, folder), ["g"], LEDGER_ORDER, F.col("len"), "off")
    kept = extents.where("attempt <= 5").select("g", "off", "len", "l_orderkey")
    return chunking.merge_ranges(kept, ["g"], "off", "len", 400).select("g", "offset", "total", "n")


@query("win_merge_near_ranges", f"""
WITH RECURSIVE {SEQ_SQL}, steps AS MATERIALIZED (
  SELECT g, row_number() OVER (PARTITION BY g ORDER BY rn) AS pos, upto - len AS off, upto AS stop FROM seq
  WHERE attempt <= 1),
walk AS (
  SELECT g, pos, off AS start, stop FROM steps WHERE pos = 1
  UNION ALL
  SELECT s.g, s.pos, CASE WHEN c.stop - c.start >= 80 OR s.off - c.stop > 40 THEN s.off ELSE c.start END, s.stop
  FROM walk c JOIN steps s ON s.g = c.g AND s.pos = c.pos + 1)
SELECT g, CAST(start AS BIGINT) AS "offset", CAST(max(stop) - start AS BIGINT) AS total, count(*) AS n
FROM walk GROUP BY g, start""")
def win_merge_near_ranges(spark, folder):
    extents = ordered.start_offset(ledger(spark, folder), ["g"], LEDGER_ORDER, F.col("len"), "off")
    kept = extents.where("attempt <= 1").select("g", "off", "len", "l_orderkey")
    return chunking.merge_ranges(kept, ["g"], "off", "len", 80).select("g", "offset", "total", "n")


@query("win_resume_page", f"""
WITH {SEQ_SQL},
cursors AS (SELECT o_orderkey % 16 AS g, max(o_orderkey) - 64 AS cursor FROM orders GROUP BY 1),
found AS (SELECT s.g, min(s.rn) AS rn FROM seq s JOIN cursors c ON c.g = s.g AND c.cursor = s.l_orderkey GROUP BY s.g),
rest AS (
  SELECT s.*, sum(s.len) OVER (PARTITION BY s.g ORDER BY s.rn ROWS UNBOUNDED PRECEDING) AS page_upto
  FROM seq s LEFT JOIN found f ON f.g = s.g WHERE s.rn > coalesce(f.rn, 0) AND s.attempt <= 5)
SELECT g, l_orderkey, l_linenumber, len FROM rest WHERE page_upto - len < 150""")
def win_resume_page(spark, folder):
    orders = table(spark, folder, "orders")
    cursors = orders.groupBy((F.col("o_orderkey") % 16).alias("g")).agg((F.max("o_orderkey") - 64).alias("cursor"))
    page = ordered.resume_page(
        ledger(spark, folder), ["g"], LEDGER_ORDER, "l_orderkey", F.col("len"), cursors, 150, F.col("attempt") <= 5
    )
    return page.select("g", "l_orderkey", "l_linenumber", "len")


@query("win_dedupe_first", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {ORDER_SQL}) AS rn FROM lineitem)
WHERE rn = 1""")
def win_dedupe_first(spark, folder):
    rows = picking.dedupe(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], LEDGER_ORDER)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("win_pick_attempt", """
SELECT user_id, min(event_id) AS event_id FROM events WHERE event_type = 'purchase' AND event_id % 10 <> 0 GROUP BY user_id""")
def win_pick_attempt(spark, folder):
    events = table(spark, folder, "events").withColumn("at", F.col("event_id"))
    obsolete = F.col("event_id") % 10 == 0
    return picking.pick_attempt(events, "user_id", "event_id", "at", F.col("event_type") == "purchase", obsolete)


@query("win_first_good_replica", f"""
WITH {LEDGER_SQL} SELECT l_orderkey, replica, l_linenumber, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY replica, {ORDER_SQL}) AS rn FROM ledger WHERE ok)
WHERE rn = 1""")
def win_first_good_replica(spark, folder):
    rows = picking.first_good(ledger(spark, folder), "l_orderkey", "replica", F.col("ok"), LEDGER_ORDER)
    return rows.select("l_orderkey", "replica", "l_linenumber", "l_partkey")


@query("win_no_good_replica", f"""
WITH {LEDGER_SQL} SELECT l_orderkey, count(DISTINCT replica) AS replicas FROM ledger GROUP BY l_orderkey
HAVING NOT bool_or(ok)""")
def win_no_good_replica(spark, folder):
    return picking.without_good(ledger(spark, folder), "l_orderkey", "replica", F.col("ok"))


@query("win_tier_coalesce", f"""
WITH {LEDGER_SQL} SELECT l_orderkey, l_linenumber, tier, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY tier, {ORDER_SQL}) AS rn FROM ledger)
WHERE rn = 1""")
def win_tier_coalesce(spark, folder):
    rows = ledger(spark, folder)
    rows = picking.coalesce_tiers(rows, ["l_orderkey", "l_linenumber"], F.col("tier"), LEDGER_ORDER)
    return rows.select("l_orderkey", "l_linenumber", "tier", "l_partkey")


@query("win_budget_pick", f"""
WITH {LEDGER_SQL}, sizes AS (SELECT l_suppkey, CAST(sum(len) AS BIGINT) AS size FROM ledger GROUP BY l_suppkey),
ranked AS (SELECT *, sum(size) OVER (ORDER BY size DESC, l_suppkey ROWS UNBOUNDED PRECEDING) - size AS picked FROM sizes)
SELECT l_suppkey, size FROM ranked WHERE picked <= 500000 AND (size > 15800 OR picked <= 250000)""")
def win_budget_pick(spark, folder):
    return picking.budget_pick(sizes(spark, folder), "l_suppkey", "size", 600000, 100000, 15800)


@query("win_diverse_topk", """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS rn FROM supplier),
must AS (SELECT * FROM ranked WHERE rn = 1 ORDER BY s_acctbal DESC, s_suppkey LIMIT 40),
prefer AS (SELECT * FROM ranked ORDER BY CASE WHEN rn > 1 THEN 1 ELSE 0 END, s_acctbal DESC, s_suppkey LIMIT 40),
plain AS (SELECT * FROM ranked ORDER BY s_acctbal DESC, s_suppkey LIMIT 40)
SELECT 'must' AS mode, s_suppkey, CAST(row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) - 1 AS INTEGER) AS pos FROM must
UNION ALL
SELECT 'prefer', s_suppkey,
       CAST(row_number() OVER (ORDER BY CASE WHEN rn > 1 THEN 1 ELSE 0 END, s_acctbal DESC, s_suppkey) - 1 AS INTEGER)
FROM prefer
UNION ALL
SELECT 'none', s_suppkey, CAST(row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) - 1 AS INTEGER) FROM plain""")
def win_diverse_topk(spark, folder):
    nodes = table(spark, folder, "supplier")
    order = [F.col("s_acctbal").desc(), F.col("s_suppkey")]
    picks = [
        picking.diverse_topk(nodes, 40, "s_nationkey", order, mode).select(F.lit(mode).alias("mode"), "s_suppkey", "pos")
        for mode in ("must", "prefer", "none")
    ]
    return picks[0].unionByName(picks[1]).unionByName(picks[2])


@query("win_rank_by_load", """
SELECT s_suppkey, CAST(row_number() OVER (
         ORDER BY s_acctbal / (CAST(s_suppkey % 7 AS BIGINT) + greatest(1000 * 2 // 9, 1)) DESC, s_suppkey) - 1 AS BIGINT) AS pos
FROM supplier""")
def win_rank_by_load(spark, folder):
    nodes = table(spark, folder, "supplier")
    ranked = picking.rank_load(nodes, F.col("s_acctbal"), F.col("s_suppkey") % 7, 1000, 2, 9, ["s_suppkey"])
    return ranked.select("s_suppkey", "pos")


@query("win_rank_cost_then_load", """
SELECT s_suppkey, CAST(row_number() OVER (
         ORDER BY CASE WHEN s_acctbal >= 0 THEN CAST(s_nationkey AS BIGINT) ELSE 9223372036854775807 END, s_suppkey % 7,
                  s_suppkey) - 1 AS BIGINT) AS pos
FROM supplier""")
def win_rank_cost_then_load(spark, folder):
    nodes = table(spark, folder, "supplier")
    healthy = F.col("s_acctbal") >= 0
    ranked = picking.rank_cost(nodes, F.col("s_nationkey"), healthy, F.col("s_suppkey") % 7, ["s_suppkey"])
    return ranked.select("s_suppkey", "pos")


@query("win_pick_healthy_least_loaded", """
WITH load AS (SELECT o_custkey % 50 AS target, count(*) AS n FROM orders GROUP BY 1),
best AS (SELECT target FROM load ORDER BY CASE WHEN target % 3 <> 0 THEN 0 ELSE 1 END, n, target LIMIT 1)
SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_custkey % 50 ELSE (SELECT target FROM best) END AS target FROM customer""")
def win_pick_healthy_least_loaded(spark, folder):
    customers = table(spark, folder, "customer")
    load = table(spark, folder, "orders").groupBy((F.col("o_custkey") % 50).alias("target")).agg(F.count(F.lit(1)).alias("n"))
    existing = customers.where("c_acctbal > 5000").select("c_custkey", (F.col("c_custkey") % 50).alias("target"))
    return picking.pick_target(customers, load, existing, "c_custkey", "target", F.col("target") % 3 != 0, F.col("n"))


@query("win_prefer_healthy_k", f"""
WITH {LEDGER_SQL}, a AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN ok THEN 0 ELSE 1 END, {ORDER_SQL}) AS r1 FROM ledger),
b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {ORDER_SQL}) AS r2 FROM a WHERE r1 > 2)
SELECT l_orderkey, l_linenumber, l_partkey, 1 AS round FROM a WHERE r1 <= 2
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 2 FROM b WHERE r2 <= 1""")
def win_prefer_healthy_k(spark, folder):
    rows = picking.prefer_healthy(ledger(spark, folder), "l_orderkey", LEDGER_ORDER, ~F.col("ok"), 2, 3)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "round")


@query("win_sticky_hash_place", """
WITH writable AS (SELECT s_suppkey AS target, row_number() OVER (ORDER BY s_suppkey) - 1 AS at FROM supplier WHERE s_acctbal > 0),
size AS (SELECT count(*) AS n FROM writable)
SELECT c_custkey, coalesce(held.target, hashed.target) AS target
FROM customer CROSS JOIN size
LEFT JOIN writable held ON c_acctbal > 5000 AND held.target = c_custkey % 120
LEFT JOIN writable hashed ON hashed.at = CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 15) AS BIGINT) % n""")
def win_sticky_hash_place(spark, folder):
    customers = table(spark, folder, "customer")
    targets = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("target"), "s_acctbal")
    existing = customers.where("c_acctbal > 5000").select("c_custkey", (F.col("c_custkey") % 120).alias("target"))
    return picking.place(customers, existing, targets, "c_custkey", "target", F.col("s_acctbal") > 0)


@query("win_round_robin_buckets", """
SELECT c_custkey, i AS copy, CAST((rn * 2 + i) % 7 AS INTEGER) AS bucket
FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS rn FROM customer), (VALUES (0), (1)) v(i)""")
def win_round_robin_buckets(spark, folder):
    return placement.round_robin(table(spark, folder, "customer").select("c_custkey"), ["c_custkey"], 7, 2)


@query("win_contiguous_buckets", """
WITH p AS (SELECT count(*) AS items FROM customer),
q AS (SELECT greatest(1, least(items, 120) // (7 * 3)) AS run, (items + 2) // 3 AS ranges FROM p),
z AS (SELECT run, ranges // (run * 7) * run * 7 AS dealt, ranges % (run * 7) // 7 AS few, ranges % (run * 7) % 7 AS more FROM q),
placed AS (SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // 3 AS k FROM customer),
base AS (
  SELECT c_custkey, k, CASE WHEN k < dealt THEN k // run % 7
                            WHEN k - dealt < more * (few + 1) THEN (k - dealt) // (few + 1)
                            ELSE more + (k - dealt - more * (few + 1)) // greatest(few, 1) END AS b
  FROM placed, z)
SELECT c_custkey, CAST(k AS BIGINT) AS range, i AS copy, CAST((b + i) % 7 AS INTEGER) AS bucket
FROM base, (VALUES (0), (1)) v(i)""")
def win_contiguous_buckets(spark, folder):
    return placement.contiguous(table(spark, folder, "customer").select("c_custkey"), ["c_custkey"], 7, 3, 120, 2)


@query("win_hysteresis", """
WITH usage AS (SELECT user_id, ts, event_id, event_id * 37 % 101 AS pct FROM events),
marked AS (SELECT *, CASE WHEN pct >= 80 THEN 'off' WHEN pct <= 30 THEN 'on' END AS mark FROM usage)
SELECT event_id, user_id, pct, coalesce(last_value(mark IGNORE NULLS) OVER (
         PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 'on') AS state
FROM marked""")
def win_hysteresis(spark, folder):
    usage = table(spark, folder, "events").select("user_id", "ts", "event_id", (F.col("event_id") * 37 % 101).alias("pct"))
    marked = ordered.switch_state(usage, ["user_id"], ["ts", "event_id"], F.col("pct"), 80, 30)
    return marked.select("event_id", "user_id", "pct", "state")
