"""Repeated passages across documents by suffix arrays.

Every byte covered by a 50-byte string that also starts in a document with a smaller doc_id is removed.

1. Anchors: in any 50 bytes, the byte groups of smallest hash are chosen by content alone, so equal strings have equal
   anchors.  Anchors are sorted inside tasks and read as a stream; those met in two documents survive, if 16 bytes before
   or after them are equal too: of two strings of 50 bytes around one group, one side has so many or more.
2. Around surviving anchors the text is cut into pieces, keyed by the place of the anchor's first occurrence.  Equal
   pieces are kept once, under their smallest document; in all others they go whole.
3. Pieces are dealt to shards by key.  A shard's suffix array comes from induced sorting: suffixes are classified,
   leftmost-smaller (LMS) substrings are named in order, the reduced string of names is ranked, and all other suffixes are
   induced in two linear scans, bucket by bucket.  Permuted common prefixes, computed where they cannot be derived from
   their left neighbour, tell which neighbours in the array share 50 bytes.
4. Covered ranges are united per document and cut out.

All strings that share 50 bytes share an anchor, so they meet in one shard whole, and no match is lost.

Defined cases: null text counts as empty; texts under 50 bytes are untouched; documents with null doc_id neither remove
nor lose anything; rows with the same doc_id do not remove each other; rows that repeat doc_id and text get equal results.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, query, table
from millrace.session import drop_table, persist_table, ship_with_tasks

ship_with_tasks(__name__)

LENGTH = 50
# Bytes of an anchor, and group starts in a window of LENGTH bytes.
GROUP = 18
WINDOW = LENGTH - GROUP + 1
# Bytes beside an anchor that tell, on one side or the other, whether a string around it can be shared.
SIDE = (LENGTH - GROUP) // 2
# Bytes of the first occurrence's document that share a key, and bytes of pieces in a shard, on average.
STRETCH, SHARD_BYTES = 2048, 2 << 20
# Bytes of documents whose anchors are found at once, about.
RUN = 1 << 16
# Parts of the documents that are shuffled to their anchors one after the other.
ROUNDS = 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """Best of each ``width`` values in a row, by doubling."""
    size = 1
    while 2 * size <= width:
        x = best(x[:-size], x[size:])
        size *= 2
    return best(x[:len(x) - (width - size)], x[width - size:]) if size < width else x


def anchors(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places, hashes, before, after) of the anchors in concatenated documents that end at ``ends``.

    The last two are hashes of 16 bits, never 0, of the bytes on either side, which may be those of another document.
    """
    if len(text) < LENGTH:
        return np.zeros(0, np.int64), *(np.zeros(0, np.uint64) for _ in range(3))
    wide = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = wide[:-8].copy()
    for k in range(1, 8):
        word |= wide[k:len(wide) - 8 + k] << np.uint64(8 * k)
    n = len(text) - GROUP + 1
    hashes = _mix(_mix(_mix(word[:n]) + word[8:8 + n]) + word[GROUP - 8:GROUP - 8 + n])
    least = _sliding(hashes, WINDOW, np.minimum)
    for k in range(1, LENGTH):  # windows that run over the end of a document
        at = ends - k
        least[at[(at >= 0) & (at < len(least))]] = 0
    edge = np.zeros(WINDOW - 1, np.uint64)
    chosen = _sliding(np.concatenate([edge, least, edge]), WINDOW, np.maximum)
    places = np.flatnonzero(chosen == hashes)
    sides = []
    for first in (places - SIDE, places + GROUP):
        left, right = (word[(first + k).clip(0, len(word) - 1)] for k in (0, SIDE - 8))
        sides.append((_mix(_mix(left) + right) >> np.uint64(48)).clip(min=1))
    return places, hashes[places], *sides


def classify(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (type S).  The last character is the smallest and unique."""
    n = len(text)
    place = np.where(np.append(text[:-1] != text[1:], True), np.arange(n), n)
    change = np.minimum.accumulate(place[::-1])[::-1].clip(max=n - 2)
    small = text[change] < text[change + 1]
    small[-1] = True
    return small


def rank_by_doubling(names: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes of the reduced string, whose names tell how many are smaller; each round doubles the number of
    names compared.  Only suffixes that are not told apart yet are sorted again."""
    rank, step, n = names.astype(np.int64), 1, len(names)
    at = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    while len(at):
        following = np.where(at + step < n, rank[np.minimum(at + step, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + following
        order = np.argsort(key)
        key, at = key[order], at[order]
        old = rank[at]
        new_old = np.append(True, old[1:] != old[:-1])
        new_key = np.append(True, key[1:] != key[:-1])
        place = np.arange(len(at))
        rank[at] = old + np.maximum.accumulate(np.where(new_key, place, 0)) - np.maximum.accumulate(np.where(new_old, place, 0))
        at = at[~(new_key & np.append(new_key[1:], True))]
        step *= 2
    return rank


def name_substrings(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Order-preserving names of the LMS substrings: six (character, type) pairs at a time."""
    coded = text.astype(np.uint64) * np.uint64(2) + small
    coded = np.concatenate([coded, np.zeros(8, np.uint64)])
    length = np.append(lms[1:] - lms[:-1] + 1, 1)
    # A name is the number of substrings known to be smaller; only those not read to their end are sorted again.
    names, done, at = np.zeros(len(lms), np.int64), 0, np.arange(len(lms))
    while len(at):
        key = np.zeros(len(at), np.uint64)
        for k in range(6):
            inside = length[at] > done + k
            value = np.where(inside, coded[np.minimum(lms[at] + done + k, len(coded) - 1)] + np.uint64(1), np.uint64(0))
            key = key * np.uint64(1024) + value
        order = np.lexsort((key, names[at]))
        key, old = key[order], names[at[order]]
        new_name = np.append(True, old[1:] != old[:-1])
        new_key = new_name | np.append(True, key[1:] != key[:-1])
        place = np.arange(len(at))
        head = np.maximum.accumulate(np.where(new_key, place, 0)) - np.maximum.accumulate(np.where(new_name, place, 0))
        names[at[order]] = old + head
        done += 6
        at = at[length[at] > done]
    return names


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffix array of ``text`` (values under 500, the last one unique and smallest) by induced sorting."""
    n = len(text)
    small = classify(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    names = name_substrings(text, small, lms)
    order = np.empty_like(lms)
    order[rank_by_doubling(names)] = lms

    top = int(text.max()) + 1
    begin = text[order]
    by_char = np.argsort(begin, kind="stable")
    bounds = np.searchsorted(begin[by_char], np.arange(top + 1, dtype=begin.dtype))
    starts = [order[by_char[bounds[c]:bounds[c + 1]]] for c in range(top)]

    def induce(chars, first, wanted):
        """Scan the buckets; entries pass on their left neighbours of type ``wanted`` in the order they stand."""
        found: list[list[np.ndarray]] = [[] for _ in range(top)]
        result = []
        for c in chars:
            def send(entries, c=c):
                ahead = entries[entries > 0] - 1
                ahead = ahead[small[ahead] == wanted]
                keys = text[ahead]
                same = keys == c
                rest, keys = ahead[~same], keys[~same]
                if len(rest):
                    sort = np.argsort(keys, kind="stable")
                    rest, keys = rest[sort], keys[sort]
                    cuts = np.flatnonzero(np.diff(keys)) + 1
                    for part, key in zip(np.split(rest, cuts), keys[np.append(0, cuts)].tolist(), strict=True):
                        found[key].append(part)
                return ahead[same]

            wave, own = (np.concatenate(found[c]) if found[c] else np.zeros(0, np.int64)), []
            while len(wave):
                own.append(wave)
                wave = send(wave)
            send(first[c])
            result.append(np.concatenate(own) if own else np.zeros(0, np.int64))
        return result

    large = induce(range(top), starts, False)
    # The same scan from the right: entries of type L pass on neighbours of type S, last first.
    back = induce(range(top - 1, -1, -1), [x[::-1] for x in large], True)[::-1]
    out = np.concatenate([x for c in range(top) for x in (large[c], back[c][::-1])])
    return np.concatenate([[n - 1], out]) if len(out) == n - 1 else out


def common_prefixes(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """For each place, the length it shares with its left neighbour in the array (the permuted common prefixes)."""
    n = len(text)
    left = np.empty(n, np.int64)
    left[array[1:]] = array[:-1]
    left[array[0]] = 0
    place = np.arange(n)
    before = np.append(text.dtype.type(-1), text[:-1])
    derived = before == before[left]
    derived[0] = False
    todo = np.flatnonzero(~derived)
    length = np.zeros(n, np.int64)
    todo = todo[todo != array[0]]
    # Four characters at a time while all four are equal, then one at a time; the last character is unique, so every
    # comparison ends.
    wide = np.concatenate([text, np.zeros(3, text.dtype)]).astype(np.uint64)
    four = wide[:n] | wide[1:n + 1] << np.uint64(16) | wide[2:n + 2] << np.uint64(32) | wide[3:] << np.uint64(48)
    for words, step in ((four, 4), (text, 1)):
        here, at, other = todo, todo + length[todo], left[todo] + length[todo]
        while len(here):
            equal = words[at] == words[other]
            here, at, other = here[equal], at[equal] + step, other[equal] + step
            length[here] += step
    origin = np.maximum.accumulate(np.where(derived, 0, place))
    return length[origin] - (place - origin)


def repeated_ranges(pieces: list[bytes], docs: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per piece the ranges covered by 50-byte strings that also start in a piece of a smaller document."""
    size = np.array([len(p) for p in pieces])
    # 16 bits: numpy sorts such keys by radix.
    text = np.frombuffer(b"\0".join(pieces) + b"\0\0", np.uint8).astype(np.int16) + np.int16(2)
    start = np.cumsum(size + 1) - size - 1
    text[start + size] = 1  # between pieces
    text[-1] = 0
    array = suffix_array(text)
    shared = common_prefixes(text, array)[array] >= LENGTH
    # Only suffixes that share with a neighbour: each run of them begins with one that does not share with its left.
    near = shared.copy()
    near[:-1] |= shared[1:]
    array, shared = array[near], shared[near]
    owner = np.append(np.repeat(np.arange(len(size)), size + 1), len(size) - 1)[array]
    inside = array + LENGTH <= start[owner] + size[owner]
    first, own = np.flatnonzero(~shared), docs[owner]
    least = np.repeat(np.minimum.reduceat(own, first), np.diff(np.append(first, len(own)))) if len(own) else own
    place = np.sort(array[inside & (own > least)])
    out: list[list[tuple[int, int]]] = [[] for _ in pieces]
    if len(place):
        cut = np.flatnonzero(np.diff(place) > LENGTH) + 1
        own = np.searchsorted(start, place, "right") - 1
        cut = np.union1d(cut, np.flatnonzero(np.diff(own)) + 1)
        for part in np.split(place, cut):
            k = int(np.searchsorted(start, part[0], "right") - 1)
            out[k].append((int(part[0] - start[k]), int(part[-1] - start[k] + LENGTH)))
    return out


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(h, doc_id, same, spot) for each anchor: in ``spot`` its place above what ``anchors`` tells of the bytes before and after
    it, 16 bits each, 0 where the document has too few.
    """
    def found(batches):
        for batch in batches:
            if not len(batch):
                continue
            raw = [x.encode() for x in batch["text"]]
            ends = np.cumsum([len(x) for x in raw])
            begin = np.concatenate([[0], ends[:-1]])
            # Anchors never look beyond their document: a few documents at a time stay in the processor's cache.
            cuts = np.flatnonzero(np.diff(begin // RUN, prepend=-1))
            runs = []
            for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(raw)], strict=True):
                at, *found = anchors(np.frombuffer(b"".join(raw[i:j]), np.uint8), ends[i:j] - begin[i])
                runs.append((at + begin[i], *found))
            places, hashes, before, after = (np.concatenate(x) for x in zip(*runs, strict=True))
            own = np.searchsorted(ends, places, "right")
            at = places - begin[own]
            before = np.where(at < SIDE, 0, before.astype(np.int64))
            after = np.where(ends[own] - places < GROUP + SIDE, 0, after.astype(np.int64))
            yield pd.DataFrame({
                "h": hashes.view(np.int64), "doc_id": batch["doc_id"].to_numpy()[own], "same": batch["same"].to_numpy()[own],
                "spot": at << 32 | before << 16 | after,
            })

    return docs.mapInPandas(found, "h long, doc_id long, same long, spot long")


def sharing(group: np.ndarray, doc: np.ndarray, spot: np.ndarray) -> np.ndarray:
    """Whether each anchor has one of its group in another document with equal bytes before it, or with equal bytes after it."""
    out = np.zeros(len(group), bool)
    for side in (spot >> 16 & 0xFFFF, spot & 0xFFFF):
        known = np.flatnonzero(side)
        if len(known):
            code = group[known] << 16 | side[known]
            order = np.argsort(code)
            code, known = code[order], known[order]
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            many = np.maximum.reduceat(doc[known], first) != np.minimum.reduceat(doc[known], first)
            out[known] |= np.repeat(many, np.diff(np.append(first, len(known))))
    return out


def shared_anchors(rows: DataFrame) -> DataFrame:
    """(doc_id, same, spot): anchors around which two documents or more may share a string; ``spot`` is a key, made from the
    place of the anchor's first occurrence, above its place.
    """
    def kept(batches):
        run = None  # hash, first document, key, and the rows of the first document held back
        for batch in batches:
            h, doc, spot = (batch[c].to_numpy() for c in ("h", "doc_id", "spot"))
            if not len(h):
                continue
            at = spot >> 32
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(h)) + 1])
            spans = np.append(cuts, len(h))
            again = run is not None and h[0] == run[0]
            head_doc, head_at = doc[cuts].copy(), at[cuts].copy()
            if again:
                head_doc[0], head_at[0] = run[1], run[2]
            group = np.repeat(np.arange(len(cuts)), np.diff(spans))
            many = np.zeros(len(cuts), bool)
            np.logical_or.at(many, group, doc != head_doc[group])
            if again and run[3]:
                many[0] = True
            if run is not None and run[4] is not None and ((again and many[0])):
                yield _keyed(run[4], run[1], run[2])
            waiting = run[4] if again and not many[0] else None
            last = len(cuts) - 1
            use = many[group]
            # An anchor that other batches may have too is not looked at more closely, as only some of its rows are here.
            whole = use & (group != last) & ~((group == 0) & again)
            use[whole] = sharing(group[whole], doc[whole], spot[whole])
            if use.any():
                yield _keyed(batch[use], head_doc[group[use]], head_at[group[use]])
            tail = None if many[last] else batch[group == last]
            if last == 0 and waiting is not None and tail is not None:
                tail = pd.concat([waiting, tail], ignore_index=True)
            run = (h[-1], head_doc[last], head_at[last], bool(many[last]), tail)

    def _keyed(batch, doc, at):
        first = np.asarray(doc).astype(np.uint64)
        part = (np.asarray(at) // STRETCH).astype(np.uint64)
        key = _mix(_mix(np.broadcast_to(first, len(batch)).copy()) + np.broadcast_to(part, len(batch)).copy())
        # Stretches that get one key only share a shard.
        spot = (key >> np.uint64(32) << np.uint64(32)).view(np.int64) | batch["spot"].to_numpy() >> 32
        return pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "same": batch["same"].to_numpy(), "spot": spot})

    spread = rows.repartition("h").sortWithinPartitions("h", "doc_id", "spot")
    return spread.mapInPandas(kept, "doc_id long, same long, spot long")


def cut_pieces(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, same, begin, key, piece): the text around consecutive anchors of one key."""
    # A document's anchors come from all tasks, so there is nothing to gather before they are dealt out.
    gathered = found.repartition("doc_id", "same").groupBy("doc_id", "same").agg(F.sort_array(F.collect_set("spot")).alias("spots"))
    joined = docs.join(gathered, ["doc_id", "same"]).select("doc_id", "same", "text", "spots")

    def cut(batches):
        for batch in batches:
            rows = []
            for doc_id, same, text, spots in batch.itertuples(index=False):
                raw, spots = text.encode(), np.asarray(spots, np.int64)
                ats, keys = spots & 0xFFFFFFFF, spots >> 32
                apart = np.flatnonzero((np.diff(keys) != 0) | (np.diff(ats) > LENGTH + WINDOW)) + 1
                for a, k in zip(np.split(ats, apart), keys[np.append(0, apart)].tolist(), strict=True):
                    begin, end = max(0, int(a[0]) - WINDOW + 1), min(len(raw), int(a[-1]) + LENGTH)
                    rows.append((doc_id, same, begin, k, raw[begin:end]))
            yield pd.DataFrame(rows, columns=["doc_id", "same", "begin", "key", "piece"])

    return joined.mapInPandas(cut, "doc_id long, same long, begin int, key int, piece binary").where(F.length("piece") >= LENGTH)


def covered_ranges(named: DataFrame) -> DataFrame:
    """(doc_id, same, spans) of what goes; ``named`` is a table of pieces with their names, which is dropped."""
    distinct = named.groupBy("key", "name").agg(F.min("doc_id").alias("first"))
    own = F.col("doc_id") == F.col("first")
    one = named.join(distinct, ["key", "name"]).select(
        "doc_id", "same", "begin", "key", "name", F.length("piece").alias("size"), own.alias("own"), F.when(own, F.col("piece")).alias("piece")
    )
    one = persist_table(one, "owned", tidy=True)
    drop_table(named)
    unique = one.where("own").select("key", "name", "doc_id", "size", "piece").dropDuplicates(["key", "name"])
    total = unique.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = max(1, int(total) // SHARD_BYTES)

    def solve(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["key", "name"]).reset_index(drop=True)
        found = repeated_ranges([bytes(p) for p in shard["piece"]], shard["doc_id"].to_numpy())
        rows = [(k, n, a, b) for k, n, own in zip(shard["key"], shard["name"], found, strict=True) for a, b in own]
        return pd.DataFrame(rows, columns=["key", "name", "a", "b"])

    unique = unique.drop("size").withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    solved = persist_table(unique.groupBy("shard").applyInPandas(solve, "key int, name binary, a int, b int"), "solved", tidy=True)
    first = one.where("own").select("key", "name", "doc_id", "same", "begin").join(solved, ["key", "name"])
    first = first.select("doc_id", "same", (F.col("begin") + F.col("a")).alias("begin"), (F.col("begin") + F.col("b")).alias("end"))
    whole = one.where("not own").select("doc_id", "same", F.col("begin"), (F.col("begin") + F.col("size")).alias("end"))
    gone = first.unionByName(whole).groupBy("doc_id", "same").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans"))
    gone = persist_table(gone, "gone", tidy=True)
    drop_table(one)
    drop_table(solved)
    return gone


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text, kept, spans): the text as UTF-8 bytes without repeats, and the removed maximal runs of bytes."""
    bound_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("same"))
    use = docs.where("doc_id is not null")
    # Each step's shuffle files and tables go as soon as the next table is written, so the disk holds one step at a time.
    found = persist_table(shared_anchors(anchor_rows(use)), "anchors", tidy=True)
    parts = []
    for k in range(ROUNDS):
        mine = F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == k
        cut = cut_pieces(use.where(mine).dropDuplicates(["doc_id", "same"]), found.where(mine))
        parts.append(persist_table(cut.withColumn("name", F.unhex(F.md5("piece"))), "pieces", tidy=True))
    drop_table(found)
    gone = covered_ranges(functools.reduce(DataFrame.unionByName, parts)).withColumnsRenamed({"doc_id": "__id", "same": "__same"})
    joined = docs.join(gone, (F.col("doc_id") == F.col("__id")) & (F.col("same") == F.col("__same")), "left")
    cut = F.pandas_udf(cut_out, "kept binary, spans array<struct<begin:int,end:int>>")
    return joined.select("doc_id", "text", cut(F.col("text"), F.col("spans.begin"), F.col("spans.end")).alias("cut")).select("doc_id", "text", "cut.*")


def cut_out(texts: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.DataFrame:
    """Unite the ranges and leave them out."""
    rows = []
    for text, begin, end in zip(texts, begins, ends, strict=True):
        raw, spans = text.encode(), []
        for a, b in zip([] if begin is None else begin, [] if end is None else end, strict=True):
            if spans and a <= spans[-1]["end"]:
                spans[-1]["end"] = max(spans[-1]["end"], int(b))
            else:
                spans.append({"begin": int(a), "end": int(b)})
        edges = [0, *(x for s in spans for x in (s["begin"], s["end"])), len(raw)]
        rows.append((b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), spans))
    return pd.DataFrame(rows, columns=["kept", "spans"])


@query("op4_induced_suffix_repeats")
def op4_induced_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    size = F.octet_length("text").cast("long")
    return found.select(
        "doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
