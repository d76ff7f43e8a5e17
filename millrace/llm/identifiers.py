"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

Base kinds come from fixed expressions.  Their finds are seeds.  Every token with a digit is an instance; the words
before and after it are its patterns.  Spark scores the graph of patterns and instances in rounds: a pattern is as
reliable as the instances it occurs with, against all its occurrences in the corpus; an instance is as likely an
identifier as its patterns say.  Patterns that stay reliable and occur with several different seeds mark the instances
next to them, outside of base finds, as kind ``other``.

Defined cases: null text counts as empty; a null doc_id keeps its row; repeated rows get equal spans; without seeds or
reliable patterns only base spans are returned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table
from millrace.session import persist_table

KINDS = ("email", "ip", "card", "phone", "other")
ROUNDS, RELIABLE, SEEDS = 3, 0.5, 3
# Occurrences added to a pattern's count, so that a rare one is not trusted at once.
SMOOTHING = 1.0

# A match starts where its run of characters starts, or where the last match ended; possessive loops keep nothing to
# go back to, so that long runs take linear time and no stack.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Cards: single spaces and hyphens between digits are first turned into this sign.
JOINT = "\x01"
CARD = r"[0-9\x01]{2,}+"
TOKEN = r"(?<!\S)\S*?[0-9]\S*+"
BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, found, before, after) of the pattern's matches, in code points.

    What lies between matches (split) and the matches themselves alternate, which gives the places.
    """
    def place(state, i):
        start = state["at"] + F.length(F.get(state["gaps"], i))
        found = F.get(state["found"], i)
        span = F.struct(start.alias("start"), (start + F.length(found)).alias("end"), found.alias("text"), F.get(state["gaps"], i).alias("before"), F.get(state["gaps"], i + 1).alias("after"))
        return F.struct((start + F.length(found)).alias("at"), state["gaps"].alias("gaps"), state["found"].alias("found"), F.concat(state["out"], F.array(span)).alias("out"))

    empty = F.array().cast("array<struct<start:int,end:int,text:string,before:string,after:string>>")
    zero = F.struct(F.lit(0).alias("at"), F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), empty.alias("out"))
    # One-element array, so that split and matches are evaluated once.
    return F.flatten(F.transform(F.array(zero), lambda z: F.aggregate(F.sequence(F.lit(0), F.size(z["found"]) - 1), z, place, lambda s: s["out"])))


def _found(text: Column, pattern: str, trigger: str) -> Column:
    empty = F.array().cast("array<struct<start:int,end:int,text:string,before:string,after:string>>")
    return F.when(text.rlike(trigger), matches(text, pattern)).otherwise(empty)


def luhn(digits: Column) -> Column:
    def add(total, i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _kept(spans: Column, kind: int, holds: Callable[[Column], Column]) -> Column:
    good = F.filter(spans, lambda x: holds(x["text"]))
    return F.transform(good, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """Sorted array of (start, kind, end): what the fixed expressions find."""
    joined = F.regexp_replace(F.translate(text, JOINT, "\x02"), r"(?<=[0-9])[\x20-](?=[0-9])", JOINT)

    def card(x):
        digits = F.replace(x, F.lit(JOINT), F.lit(""))
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))

    return F.sort_array(F.concat(
        _kept(_found(text, EMAIL, "@"), 0, lambda x: F.lit(True)),
        _kept(_found(text, IP, r"[0-9]\.[0-9]"), 1, lambda x: x.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")),
        _kept(F.when(text.rlike("[0-9]"), matches(joined, CARD)).otherwise(F.array().cast("array<struct<start:int,end:int,text:string,before:string,after:string>>")), 2, card),
        _kept(_found(text, PHONE, r"\+[0-9]"), 3, lambda x: F.length(F.regexp_replace(x, "[^0-9]", "")).between(10, 15)),
    ))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _word(text: Column, where: str) -> Column:
    return F.lower(F.regexp_extract(text, where, 1))


def occurrences(found: DataFrame) -> DataFrame:
    """(row, start, end, token, seed, pattern): tokens with a digit and the words next to them; an edge for each pattern."""
    each = found.where("size(tokens) > 0").select("row", "base", F.explode("tokens").alias("t"))
    overlap = F.exists("base", lambda b: (b["start"] < F.col("t.end")) & (F.col("t.start") < b["end"]))
    return each.select(
        "row", "t.start", "t.end", F.lower("t.text").alias("token"), overlap.alias("seed"),
        F.explode(F.array(
            F.concat(F.lit("< "), _word(F.right("t.before", F.lit(64)), r"(\S{1,48})\s*$")),
            F.concat(F.lit("> "), _word(F.left("t.after", F.lit(64)), r"^\s*(\S{1,48})")),
        )).alias("pattern"),
    ).where("length(pattern) > 2")


def reliable_patterns(docs: DataFrame, graph: DataFrame) -> DataFrame:
    """Patterns that occur with several different seeds and hardly ever without an identifier."""
    seeded = graph.where("seed").groupBy("pattern").agg(F.count_distinct("token").alias("seeds")).where(F.col("seeds") >= SEEDS)
    seeded = persist_table(seeded, "seeded")
    graph = persist_table(graph.join(seeded, "pattern").groupBy("pattern", "token").agg(F.count("*").alias("n"), F.max("seed").alias("seed")), "graph")
    near = seeded.select(F.substring("pattern", 3, 64).alias("word")).distinct()
    everywhere = docs.select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+")).alias("word"))
    total = persist_table(everywhere.join(near, "word", "left_semi").groupBy("word").agg(F.count("*").alias("total")), "total")
    scores = graph.select("token", F.col("seed").cast("double").alias("score")).groupBy("token").agg(F.max("score").alias("score"))
    for _ in range(ROUNDS):
        scores = persist_table(scores, "scores")
        weight = graph.join(scores, "token").groupBy("pattern").agg(F.sum(F.col("n") * F.col("score")).alias("mass"))
        rated = weight.join(total, F.substring("pattern", 3, 64) == F.col("word")).select("pattern", (F.col("mass") / (F.col("total") + SMOOTHING)).alias("trust"))
        rated = persist_table(rated.withColumn("trust", F.least("trust", F.lit(0.999))), "rated")
        # An instance is an identifier unless all its patterns mislead.
        scores = graph.join(rated, "pattern").groupBy("token").agg(
            F.greatest(F.max(F.col("seed").cast("double")), 1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("score")
        )
    return rated.where(F.col("trust") >= RELIABLE)


def find(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, spans): base finds, and all finds, as sorted arrays of (start, kind, end)."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", base_spans(text).alias("base"), _found(text, TOKEN, "[0-9]").alias("tokens"))
    short = F.transform("tokens", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.left(t["text"], F.lit(64)).alias("text"), F.right(t["before"], F.lit(64)).alias("before"), F.left(t["after"], F.lit(64)).alias("after")))
    found = persist_table(found.withColumn("tokens", short), "found")
    graph = persist_table(occurrences(found), "occurrences")
    trusted = persist_table(reliable_patterns(docs, graph), "trusted")
    new = graph.where("not seed").join(trusted, "pattern", "left_semi").groupBy("row").agg(
        F.collect_set(F.struct("start", F.lit(KINDS.index("other")).alias("kind"), "end")).alias("new")
    )
    merged = found.join(persist_table(new, "new"), "row", "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return merged.select("row", "doc_id", "base", F.sort_array(F.concat("base", F.coalesce("new", none))).alias("spans"))


@query("op6_bootstrapped_identifiers")
def op6_bootstrapped_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    found = find(table(spark, folder, "documents").select("doc_id", "text"))

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    counts = map(number, KINDS[:4])
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
