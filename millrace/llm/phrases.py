"""Phrase collocations by stripes.

A stripe belongs to a prefix of 0 to 4 words and counts the words that come next.  A task reads texts as bytes, numbers the
words it meets, counts prefix and next word as numbers, and sends one row per prefix and piece of a stripe: two lists, the
next words and their counts.  Stripes with the same prefix are merged elementwise after one shuffle.  All that scoring
needs stands in the merged stripes: the counts of the extensions are the phrases of one more word, a prefix has its total in
the stripe of the prefix before it, and the largest count in a stripe tells whether an extension subsumes its prefix.

A phrase that occurs often enough consists of phrases that do, so a pass over the texts counts only words between which the
shorter phrases found before are all frequent.  Tasks know these by a bitmap of hashes of at most MOST_BITS, whatever the
corpus; a hash shared by chance costs time, never a wrong count, because words are counted as words.

The stripe of a prefix made of hot words, at least one word in HOT, is dealt in parts by its next words, so that no task
gets the whole stripe of a common prefix; there are at most HOT such words.

Defined cases: null and empty texts have no words, a null language is ``und``; repeated rows count each time; texts of any
length are read in windows of bytes that keep the last words of an unfinished piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, query, table
from millrace.operators.ordered import first_rows
from millrace.session import persist_table, ship_with_tasks

ship_with_tasks(__name__)

# Words of the longest phrase, occurrences a phrase needs, phrases reported for a language.
MAX_WORDS, LEAST, TOP = 5, 100, 2000
# Lengths of the phrases that one pass counts.
PASSES = ((1,), (2,), (3,), (4, 5))
# A hot word is at least one in so many; parts of a hot stripe, and of the stripe of the empty prefix, which holds all words.
HOT, PARTS, ROOT_PARTS = 1000, 16, 256
# Bytes of text handled at once; distinct counts and words a task holds before it sends them on.
WINDOW, HELD, HELD_WORDS = 4 << 20, 2_000_000, 1_000_000
# Bits of a bitmap for each frequent phrase, and in all.
BITS_EACH, MOST_BITS = 16, 1 << 26

_BREAKS = ".,;:!?\n\v\f\r"
_KIND = np.zeros(256, np.uint8)  # 0 in a word, 1 between words, 2 between pieces
_KIND[[ord(" "), ord("\t")]] = 1
_KIND[[ord(c) for c in _BREAKS]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_STEP, _ONES = np.uint64(0x9E3779B97F4A7C15), (1 << 64) - 1

# The next words are joined by spaces, which no word has.
_STRIPE = "lang string, n int, prefix string, part int, next string, counts array<int>"


def _word_hash(lang: str, word: str) -> int:
    return xxhash.xxh64_intdigest(f"{lang}\0{word}")


def _extend(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word."""
    return (hashes * _STEP) ^ (words + (hashes >> np.uint64(29)))


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return ((hashes * _STEP) >> np.uint64(32)) & np.uint64(bits - 1)


class Words:
    """The words a task has met in one language, numbered."""

    def __init__(self, lang: str, hot: frozenset[tuple[str, str]]):
        self.lang, self.numbers, self.hashes = lang, {}, np.zeros(0, np.uint64)
        self.hot = {word for of, word in hot if of == lang}

    def number(self, words: list[str]) -> np.ndarray:
        known = len(self.numbers)
        out = np.array([self.numbers.setdefault(w, len(self.numbers)) for w in words], np.int64)
        if len(self.numbers) > known:
            fresh = list(self.numbers)[known:]
            self.hashes = np.append(self.hashes, np.array([_word_hash(self.lang, w) for w in fresh], np.uint64))
        return out

    def names(self, numbers: np.ndarray) -> list[str]:
        names = list(self.numbers) if len(numbers) else []
        return [names[i] for i in numbers]


def split(data: np.ndarray, begins: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of lower-cased bytes and the number of the piece each is in; ``begins`` marks the bytes where a text begins."""
    kind = _KIND[data]
    inside = kind == 0
    before = np.append(False, inside[:-1]) & ~begins
    after = np.append(inside[1:], False) & ~np.append(begins[1:], True)
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    pieces = np.cumsum((kind == 2) | begins)[starts]
    offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes()))
    return words, pieces


def _windows(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Lower-cased bytes of at most about WINDOW of joined texts, where texts begin, and whether a piece goes on from before."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if pa.types.is_string(texts.type) else np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if offsets[0] == offsets[-1]:
        return
    whole = np.frombuffer(texts.buffers()[2], np.uint8)
    at, last = int(offsets[0]), int(offsets[-1])
    while at < last:
        stop = min(at + WINDOW, last)
        while stop < last:  # to the end of the word
            breaks = np.flatnonzero(_KIND[whole[stop:stop + WINDOW]])
            if len(breaks):
                stop += int(breaks[0])
                break
            stop = min(stop + WINDOW, last)
        begins = np.zeros(stop - at, bool)
        heads = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, stop)]
        begins[heads - at] = True
        yield _LOWER[whole[at:stop]], begins, not begins[0]
        at = stop


class Stripes:
    """Counts of the phrases of some lengths, by numbers of words, until they are sent."""

    def __init__(self, lengths: tuple[int, ...], hot: frozenset[tuple[str, str]]):
        self.lengths, self.hot = lengths, hot
        self.words: dict[str, Words] = {}
        self.counts: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        self.held = 0

    def add(self, lang: str, texts: pa.Array, frequent: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        carried = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for data, begins, goes_on in _windows(texts):
            words = self.words.setdefault(lang, Words(lang, self.hot))
            found, pieces = split(data, begins)
            coded = found.dictionary_encode()
            numbers = words.number(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            before = 0
            if goes_on and len(carried[0]):
                # The piece that the last window left unfinished: its last words precede those of this window.
                before = len(carried[0])
                numbers, pieces = np.append(carried[0], numbers), np.append(carried[1], pieces)
            self._count(lang, numbers, pieces, before, words.hashes, frequent)
            keep = pieces[-MAX_WORDS + 1:] == int(np.count_nonzero((_KIND[data] == 2) | begins))
            carried = numbers[-MAX_WORDS + 1:][keep], np.zeros(int(keep.sum()), np.int64)
            if self.held > HELD or sum(len(w.numbers) for w in self.words.values()) > HELD_WORDS:
                kept = words.names(carried[0])
                yield from self.send()
                carried = self.words.setdefault(lang, Words(lang, self.hot)).number(kept), carried[1]

    def _count(self, lang: str, numbers: np.ndarray, pieces: np.ndarray, before: int, hashes: np.ndarray, frequent: np.ndarray | None) -> None:
        count = len(numbers)
        starts, phrase = np.arange(count), None
        if frequent is not None and count:
            size = self.lengths[0] - 1
            phrase = hashes[numbers]
            for k in range(1, size):
                phrase = _extend(phrase[:-1], hashes[numbers[k:]])
            slots = _slots(phrase, 8 * len(frequent)).astype(np.int64)
            good = (frequent[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1
            good &= pieces[size - 1:] == pieces[:count - size + 1]
        for length in self.lengths:
            if count < length:
                continue
            at = starts[:count - length + 1]
            if frequent is not None:
                inner = length - self.lengths[0] + 2
                ok = good[:count - length + 1].copy()
                for k in range(1, inner):
                    ok &= good[k:k + len(ok)]
                at = at[ok]
            at = at[(pieces[at] == pieces[at + length - 1]) & (at + length > before)]
            if len(at):
                self._put(lang, length, *_tally(np.stack([numbers[at + k] for k in range(length)], axis=1), None))

    def _put(self, lang: str, length: int, rows: np.ndarray, n: np.ndarray) -> None:
        parts = self.counts.setdefault((lang, length), [])
        parts.append((rows, n))
        self.held += len(n)
        # Parts are merged when they have doubled, so the work stays in proportion.
        if len(parts) > 1 and sum(len(p[1]) for p in parts[1:]) > max(100_000, len(parts[0][1])):
            merged = _tally(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            self.held += len(merged[1]) - sum(len(p[1]) for p in parts)
            self.counts[lang, length] = [merged]

    def send(self) -> Iterator[pa.RecordBatch]:
        for (lang, length), parts in self.counts.items():
            rows, n = _tally(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            yield from _as_stripes(self.words[lang], length, rows, n)
        self.words, self.counts, self.held = {}, {}, 0


def _tally(rows: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of word numbers, and how often each is there (or the sum of ``n``)."""
    if rows.shape[1] <= 2:
        keys = rows[:, 0] if rows.shape[1] == 1 else (rows[:, 0] << 32) | rows[:, 1]
        order = np.argsort(keys)
        keys = keys[order]
        change = keys[1:] != keys[:-1]
    else:
        order = np.lexsort(rows.T[::-1])
        change = (rows[order[1:]] != rows[order[:-1]]).any(axis=1)
    first = np.flatnonzero(np.append(True, change))
    sums = np.diff(np.append(first, len(rows))) if n is None else np.add.reduceat(n[order], first)
    return rows[order[first]], sums


def _as_stripes(words: Words, length: int, rows: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = pa.array(list(words.numbers), pa.string())
    part = (words.hashes[rows[:, -1]] % np.uint64(ROOT_PARTS if length == 1 else PARTS)).astype(np.int32)
    if length > 1:
        hot = np.fromiter((w in words.hot for w in words.numbers), bool, len(words.numbers))
        part[~hot[rows[:, :-1]].all(axis=1)] = 0
    order = np.lexsort((part, *rows[:, :-1].T[::-1]))
    rows, n, part = rows[order], n[order], part[order]
    change = np.append(True, part[1:] != part[:-1])
    for k in range(length - 1):
        change[1:] |= rows[1:, k] != rows[:-1, k]
    edges = np.append(np.flatnonzero(change), len(n))
    for a in range(0, len(edges) - 1, 50_000):
        cut = edges[a:a + 50_001]
        heads, span = cut[:-1], slice(cut[0], cut[-1])
        prefix = [names.take(pa.array(rows[heads, k])) for k in range(length - 1)]
        joined = pc.binary_join_element_wise(*prefix, " ") if length > 2 else prefix[0] if length == 2 else pa.array([""] * len(heads))
        offsets = pa.array((cut - cut[0]).astype(np.int32))
        yield pa.RecordBatch.from_arrays([
            pa.array([words.lang] * len(heads)), pa.array([length] * len(heads), pa.int32()), joined, pa.array(part[heads]),
            pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(pa.array(rows[span, -1]))), " "),
            pa.ListArray.from_arrays(offsets, pa.array(n[span].astype(np.int32))),
        ], ["lang", "n", "prefix", "part", "next", "counts"])


def stripes(
    docs: DataFrame, lengths: tuple[int, ...], frequent: Broadcast | None = None, hot: frozenset[tuple[str, str]] = frozenset()
) -> DataFrame:
    """(lang, n, prefix, next, f): the merged stripes of the phrases of ``n`` in ``lengths`` words of ``docs`` (lang, text).

    ``frequent`` is a bitmap of the frequent phrases of one word less than the shortest, ``hot`` has the hot words (lang, word).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes(lengths, hot)
        for batch in batches:
            langs = batch["lang"].dictionary_encode()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                texts = batch["text"].filter(pc.equal(langs.indices, i))
                yield from held.add(lang, texts, None if frequent is None else frequent.value)
        yield from held.send()

    sent = docs.select("lang", "text").mapInArrow(run, _STRIPE)
    # Grouping by more than the shuffle's keys needs no second one: stripes are merged where they meet.
    met = sent.repartition("lang", "n", "prefix", "part").select("lang", "n", "prefix", "part", F.explode(F.arrays_zip(F.split("next", " ").alias("next"), "counts")).alias("x"))
    merged = met.groupBy("lang", "n", "prefix", "part", F.col("x.next").alias("next")).agg(F.sum("x.counts").alias("f"))
    return merged.select("lang", "n", "prefix", "next", "f")


def bitmap(phrases: DataFrame) -> np.ndarray:
    """The hashes of ``phrases`` (lang, phrase) as a bitmap of at most MOST_BITS, built by Spark."""
    bits = 64
    while bits < min(MOST_BITS, BITS_EACH * phrases.count()):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.zeros(batch.num_rows, np.uint64)
            for i, (lang, phrase) in enumerate(zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist(), strict=True)):
                value, *others = [_word_hash(lang, w) for w in phrase.split(" ")]
                for word in others:
                    value = (value * int(_STEP) & _ONES) ^ (word + (value >> 29) & _ONES)
                hashes[i] = value
            slots = _slots(hashes, bits).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slots >> 6), pa.array(np.uint64(1) << (slots & 63).astype(np.uint64)).view(pa.int64())], ["at", "bits"])

    marked = phrases.select("lang", "phrase").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.expr("bit_or(bits)").alias("bits"))
    # At most MOST_BITS / 64 rows of two numbers.
    rows = marked.toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint8)


def count(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, n, prefix, next, phrase, f) for the phrases of 1 to 5 words that occur ``least`` times, and (lang, words)."""
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    found, words, known, hot = [], None, None, frozenset()
    for lengths in PASSES:
        merged = stripes(docs, lengths, known, hot)
        if lengths == (1,):
            merged = persist_table(merged, "root")
            words = persist_table(merged.groupBy("lang").agg(F.sum("f").alias("words")), "words")
            total = words.agg(F.sum("words")).first()[0] or 0
            # At most HOT rows.
            hot = frozenset((r["lang"], r["next"]) for r in merged.where(F.col("f") * HOT >= total).select("lang", "next").collect())
        level = persist_table(merged.where(F.col("f") >= least).withColumn("phrase", phrase), "level")
        found.append(level)
        if lengths != PASSES[-1]:
            if known is not None:
                known.unpersist()
            known = spark.sparkContext.broadcast(bitmap(level))
    frequent = found[0]
    for level in found[1:]:
        frequent = frequent.unionAll(level)
    return frequent, words


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The best phrases of each language: (lang, rank, phrase, a, l, r, n, score)."""
    frequent, words = count(docs, least)
    total = frequent.select("lang", "phrase", "f")
    # The largest count among the extensions of a phrase, to the right (its own stripe) and to the left.
    longer = frequent.where("n > 2")
    without_first = F.expr("substring(phrase, locate(' ', phrase) + 1)")
    maxima = longer.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("f").alias("most"))
    maxima = maxima.unionAll(longer.groupBy("lang", without_first.alias("phrase")).agg(F.max("f").alias("most")))
    subsumed = maxima.groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    candidates = frequent.where("n > 1").select("lang", "phrase", F.col("f").alias("a"), "n")
    open_ = candidates.join(subsumed, ["lang", "phrase"], "left").where("most is null or most < a").drop("most")
    cuts = open_.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
    cuts = cuts.withColumns({"first": F.expr("substring_index(phrase, ' ', cut)"), "rest": F.expr("substring_index(phrase, ' ', cut - n)")})
    left = total.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = total.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    # One row per language.
    rated = cuts.drop("n").join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(words.withColumnRenamed("words", "n"), "lang")
    # Exact: decimals of 38 digits hold the products.
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    rated = rated.withColumns({"over": exact["a"] * exact["n"] * 1000, "under": exact["l"] * exact["r"]}).withColumn("score", F.expr("over div under"))
    worst = rated.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("x"))
    worst = persist_table(worst.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score"), "rated")
    best = first_rows(worst, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, "rank")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


@query("op11_phrase_stripes", r"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece
    FROM documents)),
sized AS (SELECT lang, w, unnest([1, 2, 3, 4, 5]) AS k FROM pieces),
grams AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM sized),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a FROM f WHERE k > 1 AND f >= 100),
open AS (
  SELECT * FROM cand c WHERE NOT EXISTS (
    SELECT 1 FROM cand d WHERE d.lang = c.lang AND d.k > c.k AND d.a >= c.a AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM open),
rated AS (
  SELECT c.lang, c.phrase, a, l.f AS l, r.f AS r, n, cut,
         ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN total USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
worst AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""")
def op11_phrase_stripes(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents").select("lang", "text"))
