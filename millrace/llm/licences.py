"""Licence scan: a trained paragraph classifier over word pairs, confirmed by comparison with templates.

Multinomial logistic regression over sparse word n-grams tells licence families and an unknown class apart.  It learns
from the templates, from paragraphs of a bounded sample that contain most of a template, and from other paragraphs of
that sample as unknown; what lies between confirmed and learned is neither.  The probability a family needs is calibrated,
family by family, on a part of the unknown paragraphs kept back.  A
prediction counts only if the paragraph also shares enough word pairs with a template of that family.

A paragraph is a line with a word, or several neighbouring lines that a notice is wrapped over: from each line with a pair
of a template to the first line by which enough of its pairs are met, pairs across line ends included.

Defined cases: null text has no paragraphs; a wrapped notice counts once, under its first line; repeated rows get equal
results.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table
from millrace.session import persist_table

# Documents whose paragraphs are learned from, and word pairs with a weight, at most.
SAMPLE_DOCUMENTS, SAMPLE_PARAGRAPHS, VOCABULARY = 4_000, 20_000, 5_000
# Share of a template's word pairs a paragraph must have: to be learned from, and to confirm a prediction.
LEARNED, CONFIRMED = 0.8, 0.6
LEAST_PROBABILITY = 0.5
# Share of the unknown paragraphs kept back that a family's probability must exceed; below RATED of them none can be told.
QUANTILE, RATED = 0.99, 100
UNKNOWN = "unknown"
# Lines over which a notice may be wrapped: a word a line for the longest template, and some.
WRAPPED = 32

# Usual notices of common public licences.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("LGPL", "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License"),
    ("AGPL", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD", "Use of this source code is governed by a BSD-style license."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
]


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}0-9]+", -1), "")


def _paired(x: Column) -> Column:
    return F.when(F.size(x) > 1, F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: F.concat_ws(" ", a, b))).otherwise(x)


def pairs(text: Column) -> Column:
    """The word pairs of a paragraph, in order; a single word makes one entry alone."""
    return F.transform(F.array(word_list(text)), _paired)[0]


def templates(spark: SparkSession) -> DataFrame:
    """(family, grams): the distinct word pairs of each template; a fixed small table."""
    return spark.createDataFrame(TEMPLATES, "family string, text string").select("family", F.array_distinct(pairs(F.col("text"))).alias("grams"))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(row, doc_id, line, grams, joint) for each line; ``joint`` is the pair across the end of the line before."""
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), word_list)

    def with_joint(ws):
        def one(w, i):
            before = F.get(ws, i - 1)
            joint = F.when((F.size(w) > 0) & (F.size(before) > 0), F.concat_ws(" ", F.get(before, F.size(before) - 1), F.get(w, F.lit(0))))
            return F.struct(_paired(w).alias("grams"), joint.alias("joint"))
        return F.transform(ws, one)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.transform(F.array(lines), with_joint)[0].alias("lines"))
    return rows.select("row", "doc_id", F.posexplode("lines").alias("line", "x")).select("row", "doc_id", "line", "x.grams", "x.joint")


def wrapped(rows: DataFrame) -> DataFrame:
    """(row, family, line, last): neighbouring lines of ``rows`` (row, line, grams, joint) that share CONFIRMED of a template.

    Each line with a pair of a template starts a window, which ends where the last needed pair first occurs.
    """
    fixed = templates(rows.sparkSession).collect()
    known = [(t["family"], k, g, -int(-CONFIRMED * len(t["grams"]) // 1)) for k, t in enumerate(fixed) for g in t["grams"]]
    side = F.broadcast(rows.sparkSession.createDataFrame(known, "family string, template int, gram string, need int"))  # a fixed small table
    own = F.transform(F.array_distinct("grams"), lambda g: F.struct(g.alias("gram"), F.col("line").alias("a")))
    across = F.when(F.col("joint").isNotNull(), F.array(F.struct(F.col("joint").alias("gram"), (F.col("line") - 1).alias("a")))).otherwise(F.array().cast("array<struct<gram:string,a:int>>"))
    hits = rows.where("line is not null").select("row", F.col("line").alias("b"), F.explode(F.concat(own, across)).alias("x")).select("row", "b", "x.gram", "x.a").join(side, "gram")
    spots = hits.groupBy("row", "family", "template", "need").agg(F.collect_set(F.struct("gram", "a", "b")).alias("spots"), F.count_distinct("gram").alias("n")).where("n >= need")
    spots = persist_table(spots.drop("n"), "spots")
    start = spots.select("*", F.explode("spots").alias("x")).select("row", "family", "template", "need", "x.*")
    first = start.select("row", "template", F.col("a").alias("line")).distinct()
    near = start.join(first, ["row", "template"]).where((F.col("a") >= F.col("line")) & (F.col("b") < F.col("line") + WRAPPED))
    ends = near.groupBy("row", "family", "template", "need", "line", "gram").agg(F.min("b").alias("b"))
    last = ends.groupBy("row", "family", "template", "need", "line").agg(F.sort_array(F.collect_list("b")).alias("bs"))
    return last.select("row", "family", "line", F.get("bs", F.col("need") - 1).alias("last")).where("last > line").distinct()


class Model:
    """families, weights (gram -> one number for each of unknown and the families), intercepts, cuts (family -> probability)."""

    def __init__(self, families, grams, weights, intercepts):
        self.families, self.grams, self.weights, self.intercepts = families, grams, weights, intercepts
        self.cuts = dict.fromkeys(families[1:], LEAST_PROBABILITY)

    def passes(self) -> Column:
        """Whether ``probability`` is above the cut of ``family``."""
        return F.col("probability") > F.create_map(*[F.lit(x) for pair in self.cuts.items() for x in pair])[F.col("family")]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(g, [float(x) for x in self.weights[:, i]]) for i, g in enumerate(self.grams)]
        return spark.createDataFrame(rows, "gram string, weights array<double>")


def train(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> Model:
    """Fit on templates and on paragraphs of at most ``documents`` documents (those with ids of smallest hash)."""
    spark = docs.sparkSession
    known = templates(spark)
    chosen = docs.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    lines = persist_table(paragraphs(docs.join(F.broadcast(chosen), "doc_id", "left_semi")), "sampled")
    # Parts of a wrapped notice are no example of anything.
    parts = wrapped(lines).select("row", F.explode(F.sequence("line", "last")).alias("line")).distinct()
    sample = lines.where("size(grams) > 1").join(parts, ["row", "line"], "left_anti").select(F.array_distinct("grams").alias("grams"))
    # A score for each of the few templates: a fixed number of columns, not a product of tables.
    fixed = known.collect()
    scored = sample.distinct().orderBy(F.xxhash64("grams"), "grams").limit(SAMPLE_PARAGRAPHS)
    best = F.array_max(F.array(*[
        F.struct((F.size(F.array_intersect("grams", F.array(*map(F.lit, t["grams"])))) / len(t["grams"])).alias("share"), F.lit(t["family"]).alias("family")) for t in fixed
    ]))
    labelled = scored.withColumn("best", best).where((F.col("best.share") >= LEARNED) | (F.col("best.share") < CONFIRMED)).select("grams", F.when(F.col("best.share") >= LEARNED, F.col("best.family")).otherwise(F.lit(UNKNOWN)).alias("family"))
    labelled = labelled.withColumn("weight", F.lit(1.0)).unionByName(known.select("grams", "family", F.lit(20.0).alias("weight")))
    families = [UNKNOWN, *sorted({f for f, _ in TEMPLATES})]
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    data = persist_table(labelled.select("grams", "weight", number.cast("double").alias("label"), (F.abs(F.xxhash64("grams")) % 4 == 0).alias("kept_back")), "licences")
    vectorizer = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, minDF=1.0, binary=True)
    grams = vectorizer.fit(data.where("label > 0"))  # only pairs that licence texts have can point to a licence
    learned = grams.transform(data.where("label > 0 or not kept_back"))
    fitted = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=60, weightCol="weight").fit(learned)
    model = Model(families, grams.vocabulary, np.asarray(fitted.coefficientMatrix.toArray()), np.asarray(fitted.interceptVector.toArray()))
    model.intercepts = np.resize(model.intercepts, len(families)) if len(model.intercepts) == len(families) else np.zeros(len(families))
    back = paragraph_scores(data.where("label = 0 and kept_back").select(F.monotonically_increasing_id().alias("row"), F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("line"), "grams", F.lit(None).cast("string").alias("joint")), model)
    own = [F.percentile(F.when(F.col("family") == f, F.col("probability")).otherwise(0.0), QUANTILE).alias(f) for f in families[1:]]
    rated = back.where("line is not null").agg(F.count("*").alias("n"), *own).first()
    if rated["n"] >= RATED:
        model.cuts = {f: max(LEAST_PROBABILITY, rated[f]) for f in families[1:]}
    return model


def paragraph_scores(rows: DataFrame, model: Model) -> DataFrame:
    """(row, doc_id, line, family, probability, grams, joint) for each paragraph with a known pair: its likeliest family.

    A mark on each document's first line, kept as line null, brings documents without known pairs into the result.
    """
    spark = rows.sparkSession
    weights = model.table(spark).unionByName(spark.createDataFrame([("", None)], "gram string, weights array<double>"))
    grams = F.when(F.col("line") == 0, F.concat(F.array_distinct("grams"), F.array(F.lit("")))).otherwise(F.array_distinct("grams"))
    each = F.concat(F.transform(grams, lambda g: F.struct(g.alias("gram"), F.lit(False).alias("across"))), F.array(F.struct(F.col("joint").alias("gram"), F.lit(True).alias("across"))))
    hits = rows.select("row", "doc_id", "line", F.explode(each).alias("x")).select("row", "doc_id", "line", "x.*").join(F.broadcast(weights), "gram")  # at most VOCABULARY rows
    place = F.when(F.col("gram") != "", F.col("line"))
    n = len(model.families)
    sums = hits.groupBy("row", "doc_id", place.alias("line")).agg(*[F.sum(F.when(~F.col("across"), F.col("weights")[k])).alias(f"z{k}") for k in range(n)], F.collect_set(F.when(~F.col("across"), F.col("gram"))).alias("grams"), F.max(F.when(F.col("across"), F.col("gram"))).alias("joint"))
    z = [F.col(f"z{k}") + F.lit(float(model.intercepts[k])) for k in range(n)]
    top = F.greatest(*z)
    total = sum((F.exp(x - top) for x in z[1:]), F.exp(z[0] - top))
    best = F.array_max(F.array(*[F.struct(x.alias("z"), F.lit(f).alias("family")) for x, f in zip(z[1:], model.families[1:], strict=True)]))
    return sums.select("row", "doc_id", "line", "grams", "joint", best["family"].alias("family"), (F.exp(best["z"] - top) / total).alias("probability"))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """(row, doc_id, found): for each document the confirmed (line, family, probability, last), in order."""
    fixed = templates(docs.sparkSession).collect()
    confirmed = F.greatest(F.lit(0.0), *[
        F.when(F.col("family") == t["family"], F.size(F.array_intersect("grams", F.array(*map(F.lit, t["grams"])))) / len(t["grams"])).otherwise(0.0) for t in fixed
    ]) >= CONFIRMED
    good = F.col("line").isNotNull() & model.passes() & confirmed
    scored = persist_table(paragraph_scores(paragraphs(docs), model), "scored")
    # The pairs of a wrapped notice's lines are scored together.
    spans = persist_table(wrapped(scored).withColumnRenamed("line", "first"), "wrapped")
    inside = scored.select("row", "line", "grams", "joint").join(spans, "row").where(F.col("line").between(F.col("first"), F.col("last")))
    own = F.when((F.col("line") > F.col("first")) & F.col("joint").isNotNull(), F.array_append("grams", F.col("joint"))).otherwise(F.col("grams"))
    whole = inside.groupBy(F.struct("row", F.col("first").alias("line"), "last", "family").alias("row")).agg(F.array_distinct(F.flatten(F.collect_list(own))).alias("grams"))
    whole = whole.select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(1).alias("line"), "grams", F.lit(None).cast("string").alias("joint"))
    whole = paragraph_scores(whole, model).where((F.col("family") == F.col("row.family")) & model.passes())
    wide = whole.groupBy(F.col("row.row").alias("row")).agg(F.collect_list(F.struct(F.col("row.line").alias("line"), "family", "probability", F.col("row.last").alias("last"))).alias("wide"))
    single = scored.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.when(good, F.struct("line", "family", "probability", F.col("line").alias("last"))))).alias("found")
    )
    both = single.join(persist_table(wide, "wide"), "row", "left")
    return both.select("row", "doc_id", F.when(F.col("wide").isNull(), F.col("found")).otherwise(_narrowest(F.concat("found", F.coalesce("wide", F.array().cast(wide.schema["wide"].dataType))))).alias("found"))


def _narrowest(found: Column) -> Column:
    """Without spans that hold another span of their family; of those that still overlap the one that ends first stays."""
    def holds(x, y):
        return (x["family"] == y["family"]) & (y["line"] >= x["line"]) & (y["last"] <= x["last"]) & ((y["last"] - y["line"]) < (x["last"] - x["line"]))

    least = F.transform(F.array(found), lambda all_: F.filter(all_, lambda x: ~F.exists(all_, lambda y: holds(x, y))))[0]

    def add(kept, x):
        met = F.exists(kept, lambda y: (x["family"] == y["family"]) & (y["last"] >= x["line"]) & (y["line"] <= x["last"]))
        return F.when(met, kept).otherwise(F.array_append(kept, x))

    by_end = F.array_sort(least, lambda x, y: F.when(x["last"] != y["last"], x["last"] - y["last"]).otherwise(x["line"] - y["line"]))
    return F.sort_array(F.aggregate(by_end, F.filter(least, lambda x: F.lit(False)), add))


@query("op8_licence_classifier")
def op8_licence_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_licences (paragraphs), families (sorted, comma-joined), lines (comma-joined), probability (the highest)."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = scan(docs, train(docs))
    return found.select(
        "doc_id", F.size("found").cast("long").alias("n_licences"), F.array_join(F.array_sort(F.array_distinct("found.family")), ",").alias("families"),
        F.array_join("found.line", ",").alias("lines"), F.coalesce(F.array_max("found.probability"), F.lit(0.0)).alias("probability"),
    )
