"""Near-duplicate documents by SimHash, found over bit counts of segments.

A fingerprint of 64 bits is embedded as the bit counts of its 16 segments of 4 bits.  The Manhattan distance of two
such vectors never exceeds the number of differing bits.  Vectors lie on a grid of unit cells, and two cells at a
distance of at most 2 have a cell in common that is at most 1 away from both; so every fingerprint is put into its own
cell and those next to it, fingerprints that meet in a cell are compared exactly, and no pair is missed.

Defined cases: null text counts as empty and has fingerprint 0; equal texts and repeated rows share a component; a null
doc_id is grouped but never names a component.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, query, table
from millrace.llm.components import components
from millrace.session import persist_table, ship_with_tasks

ship_with_tasks(__name__)

SHINGLE_WORDS, DISTANCE = 3, 2
SEGMENTS, SEGMENT_BITS = 16, 4

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_SPACES = {9: " ", 10: " ", 11: " ", 12: " ", 13: " "}


def fingerprint(text: str) -> int:
    """The SimHash of all word shingles of a text, repeats included."""
    words = [w for w in text.translate(_LOWER | _SPACES).split(" ") if w]
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles = [" ".join(words)]
    else:
        shingles = [f"{a} {b} {c}" for a, b, c in zip(words, words[1:], words[2:], strict=False)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], "<u8")
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 4096):
        part = hashes[start:start + 4096].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(shingles)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_column(spark: SparkSession, text: str = "text") -> Column:
    """The fingerprint as a signed 64-bit number."""
    bound_batches(spark)

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x) for x in texts], np.uint64).view(np.int64))

    return hashed(F.coalesce(F.col(text), F.lit("")))


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b) of ids whose fingerprints differ in at most ``distance`` (0 to 2) bits; ``prints`` (id, fp) has each fp once."""
    if not 0 <= distance <= 2:
        raise ValueError("cells next to each other show distances up to 2 only")
    counts = [F.bit_count(F.shiftrightunsigned("fp", SEGMENT_BITS * k).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))) for k in range(SEGMENTS)]
    # Counts are 0 to 4, so three bits of the cell's number hold one.
    cell = sum((F.shiftleft(c.cast("long"), 3 * k) for k, c in enumerate(counts)), F.lit(0).cast("long"))
    near = [F.when(c < SEGMENT_BITS, F.col("cell") + (1 << 3 * k)) for k, c in enumerate(counts)]
    near += [F.when(c > 0, F.col("cell") - (1 << 3 * k)) for k, c in enumerate(counts)]
    placed = (
        prints.withColumn("cell", cell).select("id", "fp", F.explode(F.array("cell", *near)).alias("cell"))
        .where("cell is not null")
    )
    # Spark takes the cells for as few rows as the fingerprints, which are 33 times fewer: it must not broadcast them.
    a, b = placed.alias("a").hint("merge"), placed.alias("b").hint("merge")
    close = (F.col("a.fp") < F.col("b.fp")) & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance)
    return a.join(b, (F.col("a.cell") == F.col("b.cell")) & close).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))


def classes(prints: DataFrame) -> DataFrame:
    """(fp, node, component) for each fingerprint of ``prints`` (doc_id, fp): its group's smallest fingerprint and smallest doc_id.

    Fingerprints are the nodes, so rows without doc_id link others too; a group of such rows alone has no component.
    """
    once = persist_table(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "prints")
    found = components(links(once.select(F.col("fp").alias("id"), "fp"))).withColumnsRenamed({"id": "fp", "component": "node"})
    grouped = persist_table(once.join(found, "fp", "left").select("fp", F.coalesce("node", "fp").alias("node"), "id"), "grouped")
    return grouped.join(grouped.groupBy("node").agg(F.min("id").alias("component")), "node").select("fp", "node", "component")


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component) for each row of ``docs``."""
    prints = persist_table(docs.select("doc_id", fingerprint_column(docs.sparkSession).alias("fp")), "fp")
    return prints.join(persist_table(classes(prints), "classes"), "fp").select("doc_id", "fp", "component")


def keep_one(docs: DataFrame) -> DataFrame:
    """The document that names its component, all columns unchanged; of repeated rows with that id one stays.

    Of a group that has no doc_id at all one row stays.
    """
    spark = docs.sparkSession
    marked = docs.withColumns({"__fp": fingerprint_column(spark), "__row": F.monotonically_increasing_id()})
    marked = persist_table(marked, "marked")
    groups = persist_table(classes(marked.select("doc_id", F.col("__fp").alias("fp"))), "classes")
    groups = groups.withColumnsRenamed({"fp": "__group_fp", "node": "__node", "component": "__component"})
    named = marked.select("doc_id", "__row", "__fp").join(groups, F.col("__fp") == F.col("__group_fp"))
    chosen = named.where(F.col("doc_id").eqNullSafe(F.col("__component"))).groupBy("__node").agg(F.min("__row").alias("__row"))
    return marked.join(chosen.select("__row"), "__row", "left_semi").select(*docs.columns)


@query("op9_simhash_popcount")
def op9_simhash_popcount(spark: SparkSession, folder: str) -> DataFrame:
    found = near_copies(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
