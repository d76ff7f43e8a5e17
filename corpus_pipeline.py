"""A corpus clean-up: quality classifier, line de-duplication, near-copies, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns documents with their columns unchanged; the last returns the tokens.
``run`` applies them to ``documents``; each result is written and read again, so that a lost executor costs one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, line_dedup, quality_gam, simhash
from millrace.llm.common import table
from millrace.session import persist_table

# A boosted model and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject; it learns from those of ``docs`` that are labelled."""
    return quality_gam.keep_good(docs, quality_gam.train(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are near copies of earlier lines; n_chars follows the text."""
    out = line_dedup.dedup(docs)
    if "n_chars" in docs.columns:
        changed = F.when(F.size("__removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed)
    return out.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids (the tokens), and the hash of the text decoded from them."""
    tokenizer = bpe.build(docs, bpe.public_path())
    return docs.select("doc_id", "lang", "source", bpe.tokens_column(spark, tokenizer).alias("t")).select("doc_id", "lang", "source", "t.*")


STAGES = [
    ("quality classifier", quality), ("line dedup", lines), ("simhash near-dedup", near_copies),
    ("benchmark decontamination", clean), ("bpe encoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = persist_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
