"""Benchmark decontamination: prefix-filtered set join with exact verification of item-sized windows.

A window is contained only if all its words are, so its necessary prefix in order of rarity is one word: the rarest by
corpus counts.  Each document's words are joined with those prefix words alone; position and length bounds drop what
cannot fit; what is left is compared word by word.

Defined cases: null text has no words; documents and items without words have no hits; each row of ``documents``
gives a row, repeated ids too; repeated items each count under their own id; items without id are not listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table
from millrace.session import persist_table
from millrace.sizing import broadcast_row_limit, has_at_most

WINDOW = 13
# Share of a document's words that must be hit: 1 of 20.
SHARE = 20
# Words of a text that travel together to the prefix join.
BLOCK = 24
# What separates the words of a text whose ASCII capitals are lowered.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    # Texts of ASCII alone, which lower() treats alike, need no look-up of each character.
    small = F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(F.translate(whole, CAPITALS, SMALL))
    # Splitting takes a sixth of the time of extracting every match; only the ends can be empty.
    return F.array_remove(F.split(small, BETWEEN, -1), "")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window, length, items): the distinct windows of all items and the sorted distinct ids of their items."""
    cut = items.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    each = cut.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("window"))
    return each.groupBy("window").agg(F.collect_set("item_id").alias("items")).select("window", F.size("window").alias("length"), "items")


def rarest(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(token, ahead, window, length, items): each window under its rarest word, which ``ahead`` words precede."""
    spots = wins.select("window", F.posexplode("window").alias("ahead", "token"))
    vocabulary = spots.select("token").distinct()
    if has_at_most(wins, broadcast_row_limit(wins.sparkSession)):
        vocabulary = F.broadcast(vocabulary)  # at most 13 words for each checked window
    seen = docs.select(F.explode_outer(words(F.col("text"))).alias("token")).join(vocabulary, "token", "left_semi").groupBy("token").count()
    ranked = spots.join(seen, "token", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token", "ahead")).alias("best")
    )
    return ranked.join(wins, "window").select(F.col("best.token").alias("token"), F.col("best.ahead").alias("ahead"), "window", "length", "items")


def nearby(marked: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, at, token, near, place): each word and the mark, with the words around it; ``place`` is its index there.

    A row of a long text must not carry all its words: texts are cut into blocks of BLOCK words, each with the WINDOW - 1
    words before and after it, which is as far as a window through a word of the block can reach.  No list here is empty; the outer
    forms of explode are used because the plain ones first evaluate the whole list once more in a filter.
    """
    reach = WINDOW - 1
    first = F.sequence(F.lit(0), F.col("n_words"), F.lit(BLOCK))
    blocks = F.transform(first, lambda i: F.struct(
        i.alias("first"), F.least(i, F.lit(reach)).alias("skip"),
        F.slice("w", F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)) + BLOCK + reach).alias("near"),
    ))
    cut = marked.select("row", "doc_id", "n_words", F.explode_outer(blocks).alias("b")).select("row", "doc_id", "n_words", "b.first", "b.skip", "b.near")
    own = F.slice("near", F.col("skip") + 1, F.lit(BLOCK))
    last = F.when(F.col("first") + BLOCK > F.col("n_words"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    spots = cut.select("row", "doc_id", "n_words", "first", "skip", "near", F.posexplode_outer(F.concat(own, last)).alias("i", "token"))
    return spots.select("row", "doc_id", "n_words", (F.col("first") + F.col("i")).alias("at"), "token", "near", (F.col("skip") + F.col("i")).alias("place"))


def hits(docs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, spans, items) for each document: its verified occurrences (start, length) and their items.

    One pass: a mark after the last word, never equal to a word, keeps documents without any hit in the result.
    """
    limit = broadcast_row_limit(docs.sparkSession)
    row = F.col("row") if "row" in docs.columns else F.monotonically_increasing_id().alias("row")
    marked = docs.select(row, "doc_id", words(F.col("text")).alias("w")).withColumn("n_words", F.size("w"))
    mark = prefixes.sparkSession.range(1).select(
        F.lit("").alias("token"), F.lit(0).alias("ahead"), F.lit(None).cast("array<string>").alias("window"),
        F.lit(0).alias("length"), F.lit(None).cast(prefixes.schema["items"].dataType).alias("items"),
    )
    side = prefixes.unionByName(mark)
    start = F.col("at") - F.col("ahead")
    fits = (start >= 0) & (start + F.col("length") <= F.col("n_words"))
    exact = F.slice("w", start + 1, F.col("length")) == F.col("window")
    if has_at_most(prefixes, limit):
        around = nearby(marked)
        found = around.join(F.broadcast(side), "token").where(F.col("window").isNull() | (fits & (F.slice("near", F.col("place") - F.col("ahead") + 1, F.col("length")) == F.col("window"))))
    else:
        # Too many windows to copy: narrow words are joined by shuffle, and only candidates meet their text again.
        marked = persist_table(marked, "words")
        spots = marked.select("row", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("at", "token"))
        near = spots.join(side, "token").where(F.col("window").isNull() | (start >= 0))
        found = near.join(marked, "row").where(F.col("window").isNull() | (fits & exact))
    kept = found.select(
        "row", "doc_id", "n_words", "items",
        F.when(F.col("window").isNotNull(), F.struct(start.alias("start"), "length")).alias("span"),
    )
    return kept.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.collect_set("span").alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )


def covered(spans: Column) -> Column:
    """How many words lie in any of the spans."""
    def add(state, span):
        end = F.greatest(state["end"], span["start"] + span["length"])
        return F.struct(end.alias("end"), (state["n"] + end - F.greatest(state["end"], span["start"])).alias("n"))

    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(F.sort_array(spans), zero, add, lambda s: s["n"]).cast("long")


def judge(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, n_hit, n_items, item_ids, contaminated) for each row of ``docs``, numbered by its column row if it has one."""
    prefixes = persist_table(rarest(docs, persist_table(windows(items), "windows")), "prefixes")
    found = hits(docs, prefixes).select(
        "row", "doc_id", F.col("n_words").cast("long").alias("n_words"), covered(F.col("spans")).alias("n_hit"),
        F.sort_array(F.transform("items", lambda x: x.cast("string"))).alias("item_ids"),
    )
    return found.select(
        "row", "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), "item_ids",
        ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows that are not contaminated, with their columns unchanged; each row is judged by its own text, whatever its id."""
    marked = persist_table(docs.withColumn("__row", F.monotonically_increasing_id()), "marked")
    judged = judge(marked.select(F.col("__row").alias("row"), "doc_id", "text"), items)
    bad = persist_table(judged.where("contaminated").select(F.col("row").alias("__row")), "bad")
    return marked.join(bad, "__row", "left_anti").select(*docs.columns)



SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
k AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS s FROM w),
g AS (
  SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS k
  FROM p, (SELECT DISTINCT n FROM k) WHERE s + n - 1 <= len(w)),
h AS (SELECT g.r, g.s, g.n, k.item_id FROM g JOIN k ON g.k = k.k AND g.n = k.n),
c AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS x FROM h) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS t FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM w LEFT JOIN c USING (r) LEFT JOIN i USING (r)
"""


@query("op3_prefix_decontaminate", SQL)
def op3_prefix_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = judge(docs, table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")
