"""Fuzzy line de-duplication: MinHash over character shingles, banding, exact Jaccard, union-find.

A line is compared lower-cased with white space collapsed.  Equal lines share a class, named by a 64-bit hash.  Class
signatures are cut into bands; classes that agree in a band meet in a bucket.  Each member is compared exactly with the
bucket's commonest class; a member that is not similar to it must still meet the others of its buckets that are not yet in
its component.  Those that can be similar share one of their rarest shingles (a prefix filter: sets of similarity 0.8 agree
in a shingle of the first fifth in any common order), so only such pairs are listed and compared.  So no pair of a bucket
that could join two components is left out.  Lines that differ from one text in little more than the similarity allows
(about 0.66 and more) still mostly meet.  Of each component the first line by (doc_id, line number) stays.

Defined cases: null text counts as empty; lines without a word always stay; lines shorter than a shingle are one shingle;
a null doc_id comes before all others; rows that repeat both doc_id and text are one document and get equal results.
"""

from __future__ import annotations

import functools
import operator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, query, table
from millrace.llm.components import components
from millrace.session import persist_table, ship_with_tasks
from millrace.sizing import has_at_most

ship_with_tasks(__name__)

# Characters of a shingle; similarity; 14 bands of 5 rows find a pair of similarity 0.8 with probability 0.996.
SHINGLE, SIMILARITY, BANDS, ROWS = 8, 0.8, 14, 5
# Class names (8 bytes each) that may be copied to every executor.
NAMES = 1_000_000
# Characters of lines whose shingles a comparison remembers.
REMEMBERED = 500_000
# Counters of shingles, and those sent in one row.  Shingles that share a counter look more frequent; the result is the same.
COUNTERS, BLOCK = 1 << 22, 1 << 16


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, same, line, cid, norm): each line with a word; ``same`` tells texts of one doc_id apart."""
    text = F.coalesce("text", F.lit(""))
    # The list is never empty; the plain form of explode would split once more in a filter.
    cut = docs.select("doc_id", F.xxhash64(text).alias("same"), F.posexplode_outer(F.split(text, "\n", -1)).alias("line", "raw"))
    # Only white space that is not already one space is replaced; most lines have none, which is seen without a pattern.
    spaced = functools.reduce(operator.or_, (F.contains("raw", F.lit(x)) for x in ("  ", "\t", "\x0b", "\f", "\r")))
    norm = F.lower(F.trim(F.when(spaced, F.regexp_replace("raw", r"\s{2,}|[^\S ]", " ")).otherwise(F.col("raw"))))
    worded = cut.where(F.ltrim("raw", F.lit(" \t\x0b\f\r")) != "")
    return worded.select("doc_id", "same", "line", norm.alias("norm")).withColumn("cid", F.xxhash64("norm"))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the shingles of all texts, one after the other, and where each text's begin."""
    # Short lines are filled up to one shingle, so every text has at least one.
    padded = [t if len(t) >= SHINGLE else t.ljust(SHINGLE, "\0") for t in texts]
    chars = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    length = np.array([len(t) for t in padded])
    start = np.cumsum(length) - length
    rolled = np.zeros(len(chars) - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        rolled *= np.uint64(0x9E3779B97F4A7C15)
        rolled += chars[k:len(rolled) + k]
    inside = np.ones(len(rolled), bool)
    ends = start + length
    for k in range(1, SHINGLE):
        inside[(ends - k)[ends - k < len(rolled)]] = False
    return _mix(rolled[inside]), np.concatenate([[0], np.cumsum(length - SHINGLE + 1)[:-1]])


def band_hashes(texts: list[str]) -> np.ndarray:
    """A (text, band) matrix of hashes; texts that agree in a band's rows agree in its hash."""
    hashes, starts = shingle_hashes(texts)
    # 32 bits each: numpy multiplies and compares them several at a time.  Chance agreements only add pairs to compare.
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    turned = np.empty_like(short)
    out = np.zeros((len(texts), BANDS), np.uint64)
    odd = _mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
    for k in range(BANDS * ROWS):
        np.multiply(short, odd[k], out=turned)
        least = np.minimum.reduceat(turned, starts).astype(np.uint64)
        band = k // ROWS
        out[:, band] = _mix(out[:, band] * np.uint64(0x9E3779B97F4A7C15) + least + np.uint64(band + 1))
    return out


def buckets(lines: DataFrame) -> DataFrame:
    """(band, cid, seen) for bands with two classes or more; ``seen`` grows with the number of places a class occurs in.

    A task names a class once for each batch it occurs in.  Bands are sorted inside tasks and read as a stream, so a task
    holds one batch and one row whatever the size of a bucket.
    """
    def signed(batches):
        for batch in batches:
            once = batch.drop_duplicates("cid")
            if len(once):
                norm = once["norm"].tolist()
                found = np.concatenate([band_hashes(norm[i:i + 200]) for i in range(0, len(norm), 200)])
                yield pd.DataFrame({"band": found.view(np.int64).ravel(), "cid": np.repeat(once["cid"].to_numpy(), BANDS)})

    def shared(batches):
        held = None
        for batch in batches:
            if not len(batch):
                continue
            # Rows are sorted, so equal ones are neighbours.
            band, cid = batch["band"].to_numpy(), batch["cid"].to_numpy()
            first = np.flatnonzero(np.concatenate([[True], (band[1:] != band[:-1]) | (cid[1:] != cid[:-1])]))
            seen = np.diff(np.append(first, len(band)))
            band, cid = band[first], cid[first]
            if held is not None:
                if held[:2] == (band[0], cid[0]):
                    seen[0] += held[2]
                else:
                    band, cid, seen = (np.concatenate([[x], xs]) for x, xs in zip(held, (band, cid, seen), strict=False))
            # A class is written as soon as another class of its band is known; the last class waits for what follows.
            same = np.zeros(len(band), bool)
            same[1:] = band[1:] == band[:-1]
            same[:-1] |= same[1:]
            same[0] |= held is not None and held[3]
            held = (band[-1], cid[-1], seen[-1], bool(same[-1]))
            done = same[:-1]
            if done.any():
                yield pd.DataFrame({"band": band[:-1][done], "cid": cid[:-1][done], "seen": seen[:-1][done]})
        if held is not None and held[3]:
            yield pd.DataFrame({"band": [held[0]], "cid": [held[1]], "seen": [held[2]]})

    rows = lines.select("cid", "norm").mapInPandas(signed, "band long, cid long")
    spread = rows.repartition("band").sortWithinPartitions("band", "cid")
    return spread.mapInPandas(shared, "band long, cid long, seen long")


def shingles(text: str) -> set[str]:
    return {text[i:i + SHINGLE] for i in range(max(1, len(text) - SHINGLE + 1))}


def alike(left: list[str], right: list[str]) -> list[bool]:
    """Whether the sets of character shingles of each pair have at least SIMILARITY (Jaccard)."""
    out, sets, held = [], {}, 0
    for pair in zip(left, right, strict=True):
        for text in pair:
            if text not in sets:
                if held > REMEMBERED:
                    sets, held = {}, 0
                sets[text] = shingles(text)
                held += len(text)
        x, y = (sets[t] if t in sets else shingles(t) for t in pair)
        most, all_ = min(len(x), len(y)), len(x) + len(y)
        # Sets of too different sizes need no comparison.
        both = len(x & y) if most / (all_ - most) >= SIMILARITY else 0
        out.append(both / (all_ - both) >= SIMILARITY)
    return out


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose lines have at least SIMILARITY."""
    @F.pandas_udf("boolean")
    def close(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(alike(left.tolist(), right.tolist()), dtype=bool)

    left = texts.select(F.col("cid").alias("a"), F.col("norm").alias("left"))
    right = texts.select(F.col("cid").alias("b"), F.col("norm").alias("right"))
    # Lengths tell nothing: a line of repeated shingles has few different ones however long it is.
    return pairs.join(left, "a").join(right, "b").where(close("left", "right")).select("a", "b")


def distinct_shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash of 56 bits) of the different shingles of each of up to 256 texts."""
    hashes, starts = shingle_hashes(texts)
    own = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(np.append(starts, len(hashes))))
    # The text's number takes 8 bits, the hash the others: one sort of numbers.
    keys = np.sort(own << np.uint64(56) | hashes >> np.uint64(8))
    keys = keys[np.append(True, keys[1:] != keys[:-1])]
    return (keys >> np.uint64(56)).astype(np.int64), keys & np.uint64((1 << 56) - 1)


def prefixes(texts: list[str], counts: np.ndarray) -> pd.DataFrame:
    """(text, token, size, ahead): the rarest shingles of each text, its number of shingles, and those not rarer than this.

    Two sets of similarity s share s of the larger one's shingles, so they agree in one of the first 1 - s of either, if
    all texts have their shingles in one order.  That order is by count; it need not be exact, only the same for all.
    """
    own, hashes = distinct_shingles(texts)
    order = np.lexsort((hashes, counts[hashes % np.uint64(len(counts))], own))
    own, hashes = own[order], hashes[order]
    size = np.bincount(own, minlength=len(texts))
    place = np.arange(len(own)) - (np.cumsum(size) - size)[own]
    size = size[own]
    # The small number keeps a product that is whole from being rounded up.
    use = place <= size - np.ceil(SIMILARITY * size - 1e-6)
    return pd.DataFrame({"text": own[use], "token": hashes[use].view(np.int64), "size": size[use], "ahead": (size - place)[use]})


def shingle_counts(texts: DataFrame) -> np.ndarray:
    """About how many of the texts have a shingle, by its hash modulo COUNTERS."""
    def count(batches):
        found = np.zeros(COUNTERS, np.int32)
        for batch in batches:
            norm = batch["norm"].tolist()
            for i in range(0, len(norm), 200):
                hashes = distinct_shingles(norm[i:i + 200])[1]
                np.add.at(found, hashes % np.uint64(COUNTERS), 1)
        rows = [(k, x.tobytes()) for k, x in enumerate(np.split(found, COUNTERS // BLOCK)) if x.any()]
        yield pd.DataFrame(rows, columns=["block", "counts"])

    def add(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int32).astype(np.int64) for x in blocks["counts"])
        return pd.DataFrame({"block": [key[0]], "counts": [total.tobytes()]})

    rows = texts.select("norm").mapInPandas(count, "block int, counts binary")
    out = np.zeros(COUNTERS, np.int64)
    # A fixed number of counters, whatever the input.
    for k, x in rows.groupBy("block").applyInPandas(add, "block int, counts binary").collect():
        out[k * BLOCK:(k + 1) * BLOCK] = np.frombuffer(x, np.int64)
    return out.clip(max=2**31 - 1).astype(np.int32)


def rare_pairs(members: DataFrame) -> DataFrame:
    """The pairs (a, b) of members (cid, apart, c, norm) that may be similar, of different c and at least one apart.

    A pair is listed if it shares one of the rarest shingles of both, and so many others follow in both that the sets can
    reach SIMILARITY.  The first shingle a similar pair shares fulfils this, so every similar pair is listed.
    """
    counts = members.sparkSession.sparkContext.broadcast(shingle_counts(members))

    def cut(batches):
        for batch in batches:
            for i in range(0, len(batch), 200):
                part = batch[i:i + 200]
                found = prefixes(part["norm"].tolist(), counts.value)
                at = found.pop("text").to_numpy()
                yield found.assign(**{x: part[x].to_numpy()[at] for x in ("cid", "apart", "c")})[["token", "cid", "apart", "c", "size", "ahead"]]

    tokens = persist_table(members.select("cid", "apart", "c", "norm").mapInPandas(cut, "token long, cid long, apart boolean, c long, size int, ahead int"), "tokens")
    left, right = tokens.where("apart").alias("x").hint("merge"), tokens.alias("y").hint("merge")
    fits = F.expr(f"least(x.ahead, y.ahead) * {1 + SIMILARITY}D >= (x.size + y.size) * {SIMILARITY}D - 1e-6D")
    # Of two that are both apart, one order is enough.
    met = left.join(right, F.expr("x.token = y.token and x.c != y.c and (not y.apart or x.cid < y.cid)") & fits)
    return met.select(F.expr("least(x.cid, y.cid)").alias("a"), F.expr("greatest(x.cid, y.cid)").alias("b")).distinct()


def line_components(lines: DataFrame) -> DataFrame:
    """(id, component) of the classes that are similar to another class."""
    found = persist_table(buckets(lines), "buckets")
    names = persist_table(found.select("cid").distinct(), "names")
    wanted = F.broadcast(names) if has_at_most(names, NAMES) else names
    texts = persist_table(lines.select("cid", "norm").join(wanted, "cid", "left_semi").dropDuplicates(["cid"]), "texts")
    pivot = found.groupBy("band").agg(F.max_by("cid", F.struct("seen", "cid")).alias("pivot"))
    # Bands are sorted in the file, which is so small that Spark would broadcast many more rows than it thinks; so are tokens.
    paired = persist_table(found.hint("merge").join(pivot, "band").where("cid != pivot").select("band", "cid", "pivot"), "paired")
    stars = paired.select(F.col("cid").alias("a"), F.col("pivot").alias("b")).distinct()
    near = persist_table(_similar(stars, texts), "near")
    known = persist_table(components(near), "known")
    # What is not similar to its bucket's commonest class meets the others of its buckets, unless they are connected.
    marked = paired.join(near.withColumn("near", F.lit(True)), (F.col("cid") == F.col("a")) & (F.col("pivot") == F.col("b")), "left")
    marked = marked.join(known, F.col("cid") == F.col("id"), "left").select("band", "cid", F.col("near").isNull().alias("apart"), F.coalesce("component", "cid").alias("c"))
    marked = persist_table(marked, "marked")
    unsettled = marked.groupBy("band").agg(F.bool_or("apart").alias("some"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("some and lo != hi")
    members = marked.join(unsettled.select("band"), "band", "left_semi").groupBy("cid").agg(F.bool_or("apart").alias("apart"), F.min("c").alias("c"))
    members = persist_table(members.join(texts, "cid"), "members")
    return components(near.unionAll(_similar(rare_pairs(members), texts)))


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, same, removed): the sorted numbers of lines that go, for documents that lose any."""
    bound_batches(docs.sparkSession)
    lines = persist_table(lines_of(docs), "lines")
    near = persist_table(line_components(lines), "components")
    # doc_id and line in one number, which Spark combines in place; null ids come first.
    place = F.coalesce(F.col("doc_id").cast("decimal(38,0)"), F.lit(str(-(2**63) - 1)).cast("decimal(38,0)")) * F.lit(str(2**31)).cast("decimal(12,0)") + F.col("line")
    placed = lines.select("doc_id", "same", "line", "cid").withColumn("place", place.cast("decimal(38,0)"))
    classes = placed.groupBy("cid").agg(F.min("place").alias("place"), F.count("*").alias("n"))
    grouped = persist_table(classes.join(near, F.col("cid") == F.col("id"), "left").where("n > 1 or component is not null").select(
        "cid", F.coalesce("component", "cid").alias("component"), "place"), "grouped")
    first = persist_table(grouped.groupBy("component").agg(F.min("place").alias("first")), "first")
    keeper = persist_table(grouped.join(first, "component").select("cid", "first"), "keeper")
    gone = placed.join(keeper, "cid").where("place != first")
    return gone.groupBy("doc_id", "same").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def _kept_text(text: Column, removed: Column) -> Column:
    # The text is split once: a list inside the function would be made anew for each of its lines.
    kept = F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains(removed, i))
    return F.when(removed.isNull(), text).otherwise(F.array_join(kept, "\n"))


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` rebuilt from the lines that stay, and ``__removed``, the numbers of those that went."""
    gone = persist_table(removed_lines(docs.select("doc_id", "text")), "removed").select(F.col("doc_id").alias("__id"), F.col("same").alias("__same"), F.col("removed").alias("__removed"))
    own = docs.withColumn("__own", F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = own.join(gone, own["doc_id"].eqNullSafe(gone["__id"]) & (F.col("__own") == F.col("__same")), "left")
    return joined.withColumn("text", _kept_text(F.col("text"), F.col("__removed"))).select(*docs.columns, "__removed")


@query("op2_line_minhash")
def op2_line_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (line numbers), kept_sha256 (of the text that stays)."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    before = docs.withColumn("n_lines", (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long"))
    return dedup(before).select(
        "doc_id", "n_lines", F.coalesce(F.size("__removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.array_join(F.coalesce("__removed", F.array().cast("array<int>")), ",").alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )
