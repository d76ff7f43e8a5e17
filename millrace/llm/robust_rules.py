"""Quality rules with a robust outlier test: minimum covariance determinant per language and source.

Every text is reduced to counts; transformed counts form a vector.  For each (lang, source) the estimate starts from
the coordinates' middle and repeats: take the rows nearest to the centre (Mahalanobis), at least RETAINED of them; compute
their mean and covariance.  A step never raises the covariance determinant.  Rows far from the final centre are rejected.
Sums are over scaled whole numbers, so the result does not depend on the order of rows.

Defined cases: null text has no words; null languages and sources are groups of their own; groups with fewer than
SMALLEST rows are pooled by language, then all together, and a pool that is still smaller rejects nothing; base failures take no
part in the estimates; repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table
from millrace.session import persist_table

VECTOR = ("length", "word_size", "symbols", "repeats")
SCALE = 1000
RETAINED, STEPS, SMALLEST = 0.75, 4, 50
# Standard deviations that a coordinate has at least (scaled), so that a constant coordinate does not reject all others.
FLOORS = (250.0, 350.0, 60.0, 120.0)
# Squared distance above which a row is rejected: the 0.99999 quantile of chi-square with 4 degrees of freedom.
CUTOFF = 28.473
# The nearest RETAINED rows spread less than all: their covariance times this is that of all rows, if those are normal.
# It is RETAINED over the chi-square probability, with 6 degrees, of the RETAINED quantile with 4 degrees (5.385).
CONSISTENCY = 1.486
# Distances are counted in steps of 1 part in 32 to find the nearest rows without sorting.
FINENESS = 32

BLANKS = r"[\x20\x09-\x0D]+"


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base counts of each row."""
    text = F.coalesce("text", F.lit(""))
    w = docs.select("doc_id", "lang", "source", text.alias("text")).withColumn("w", F.array_remove(F.split("text", BLANKS, -1), ""))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    hashed = F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.xxhash64(F.get("w", i - 1), F.get("w", i), F.get("w", i + 1)))
    counted = w.select(
        "doc_id", "lang", "source", F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", BLANKS, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"), lines.alias("lines"),
        F.when(F.size("w") >= 3, hashed).otherwise(F.array().cast("array<bigint>")).alias("triples"),
    )
    return counted.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("triples")) == F.size("triples"), F.lit(0)).otherwise(_repeated("triples")).cast("long").alias("n_repeat_words"),
    )


def _repeated(triples: str) -> Column:
    """Words inside triples that occur twice or more: sort (hash, place), mark equal neighbours, unite [place, place + 3)."""
    placed = F.sort_array(F.transform(triples, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def marked(s):
        again = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def add(state, i):
        return F.struct((i + 3).alias("end"), (state["n"] + i + 3 - F.greatest(state["end"], i)).alias("n"))

    places = F.transform(F.array(placed), marked)[0]
    return F.aggregate(places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), add, lambda s: s["n"])


def vectors(counts: DataFrame) -> DataFrame:
    """The transformed, scaled, whole-number coordinates x0, x1, ... and base_failed."""
    n = F.greatest("n_words", F.lit(1))
    whole = (
        F.log1p("n_words"), F.least(F.col("word_chars") / n, F.lit(1000.0)),
        F.log1p(10 * F.col("n_symbols") / n), F.log1p(4 * (F.col("n_repeat_words") / n + F.col("n_dup_lines") / n)),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counts.withColumns({"base_failed": failed} | {f"x{k}": F.round(SCALE * x).cast("long") for k, x in enumerate(whole)})


def pooled(rows: DataFrame) -> DataFrame:
    """Adds ``pool``: the row's own group if large enough, else its language's rest, else the rest of all."""
    own = F.to_json(F.struct("lang", "source"), {"ignoreNullFields": "false"})
    small = rows.where("not base_failed").groupBy("lang", "source").count().where(F.col("count") >= SMALLEST).select(own.alias("own"), F.lit(True).alias("large"))
    named = rows.withColumn("own", own).join(small, "own", "left")
    first = F.when(F.col("large"), F.col("own")).otherwise(F.to_json(F.struct("lang"), {"ignoreNullFields": "false"}))
    return named.withColumn("pool", first).drop("own", "large")


def _moments(rows: DataFrame) -> DataFrame:
    """Mean and lower Cholesky factor of the floored covariance per pool, as columns m0.., l00, l10, .."""
    d = len(VECTOR)
    x = [F.col(f"x{k}").cast("decimal(38,0)") for k in range(d)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}").cast("decimal(20,0)")).alias(f"p{i}{j}") for i in range(d) for j in range(i + 1)]
    out = rows.groupBy("pool").agg(F.count("*").alias("n"), *sums, *products)
    out = out.select("pool", "n", *[(F.col(f"s{i}").cast("double") / F.col("n")).alias(f"m{i}") for i in range(d)], *[f"p{i}{j}" for i in range(d) for j in range(i + 1)])
    for i in range(d):
        for j in range(i + 1):
            value = F.col(f"p{i}{j}").cast("double") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")
            value = F.greatest(CONSISTENCY * value, F.lit(FLOORS[i] ** 2)) if i == j else CONSISTENCY * value
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(value, F.lit(1e-6))) if i == j else value / F.col(f"l{j}{j}"))
    return out.select("pool", "n", *[f"m{i}" for i in range(d)], *[f"l{i}{j}" for i in range(d) for j in range(i + 1)])


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution in the joined factor."""
    z: list[Column] = []
    for i in range(len(VECTOR)):
        value = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * z[k]
        z.append(value / F.col(f"l{i}{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


def estimates(rows: DataFrame) -> DataFrame:
    """Centre and factor per pool, after STEPS concentration steps over all rows that passed the base rules.

    The start is the rows near the median in each coordinate; medians come from counts of coarse steps.
    """
    use = rows.where("not base_failed").select("pool", *[f"x{k}" for k in range(len(VECTOR))])
    middle = use.groupBy("pool").agg(*[F.percentile_approx(f"x{k}", 0.5, 10_000).alias(f"m{k}") for k in range(len(VECTOR))], F.count("*").alias("n"))
    zero = {f"l{i}{j}": F.lit(FLOORS[i] if i == j else 0.0) for i in range(len(VECTOR)) for j in range(i + 1)}
    now = persist_table(middle.withColumns(zero), "centre")
    for _ in range(STEPS):
        step = F.least(F.ceil(FINENESS * F.log1p(_distance())), F.lit(100_000)).cast("int")
        # The join copies a few numbers for each pool; above Spark's own threshold it becomes a shuffle join.
        placed = use.join(now, "pool").select("pool", "n", *[f"x{k}" for k in range(len(VECTOR))], step.alias("step"))
        tally = placed.groupBy("pool", "step").agg(F.count("*").alias("c"), F.first("n").alias("n"))
        curve = tally.groupBy("pool").agg(F.sort_array(F.collect_list(F.struct("step", "c"))).alias("curve"), F.first("n").alias("n"))

        def reach(state, s):
            done = state["c"] >= state["need"]
            return F.struct(F.when(done, state["c"]).otherwise(state["c"] + s["c"]).alias("c"), F.when(done, state["step"]).otherwise(s["step"]).alias("step"), state["need"].alias("need"))

        start = F.struct(F.lit(0).cast("long").alias("c"), F.lit(-1).alias("step"), F.ceil(F.col("n") * RETAINED).alias("need"))
        edge = persist_table(curve.select("pool", F.aggregate("curve", start, reach, lambda s: s["step"]).alias("edge")), "edge")
        now = persist_table(_moments(placed.join(edge, "pool").where("step <= edge")), "centre")
    return now


def judge(docs: DataFrame) -> DataFrame:
    """One row for each document: base counts, base_failed, the squared distance, and kept."""
    rows = persist_table(pooled(persist_table(vectors(measured(docs)), "counts")), "vectors")
    counts = rows.where("not base_failed").groupBy("pool").count()
    wide = persist_table(counts.where(F.col("count") < SMALLEST).select("pool", F.lit(True).alias("tiny")), "tiny")
    rows = rows.join(wide, "pool", "left").withColumn("pool", F.when(F.col("tiny"), F.lit("{}")).otherwise(F.col("pool"))).drop("tiny")
    centre = estimates(rows)
    far = rows.join(centre, "pool", "left").withColumn("distance", F.when(F.col("n") >= RETAINED * SMALLEST, _distance()))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= CUTOFF)
    return far.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance")


@query("op5_mcd_rules")
def op5_mcd_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
