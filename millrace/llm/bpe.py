"""Byte-level BPE with a lexicon of frequent words, and decoding.

The lexicon is a minimal acyclic transducer: an automaton in which words share prefixes and suffixes, and whose
transitions carry numbers that add up to the word's rank, under which its token ids are stored.  It is compiled once
from the most frequent words of the corpus, laid out as flat arrays in one file that Spark sends to each executor, and
memory-mapped there.  Words outside the lexicon go through the merges, so the result never depends on the lexicon.

Defined cases: null text counts as empty and has no tokens; added tokens written out in a text get their ids; very long
words are merged with a heap; repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from struct import pack

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, query, table
from millrace.session import scratch_path, ship_with_tasks

ship_with_tasks(__name__)

# Words compiled into the lexicon.  Any number gives the same tokens.
LEXICON_WORDS = 32_768
# A word is compiled only if it occurs once in so many characters; bounds what tasks send to find the most frequent.
RAREST = 20_000_000
# Segments, and words, whose tokens a Python worker remembers before it starts afresh; characters it encodes at once.
REMEMBERED, RUN = 150_000, 1 << 18
# Bytes of texts in one Arrow batch: a worker holds them, their tokens and the result several times.
BATCH_TEXT = 2 << 20

# The published pre-tokenizer pattern of byte-level BPE (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Before each space that something other than white space follows.
_SPLIT = re.compile(r"(?= \S)").split

# The rank of a pair that does not merge.
_NONE = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: itself if printable, else one above 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = (b for b in range(256) if b not in set(printable))
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(spare)}


@dataclass
class Vocabulary:
    """Ids of single bytes, the bytes of each id, merges as rows (id, id, id made) by rank, and added tokens."""

    of_byte: list[int]
    tokens: list[bytes]
    merges: np.ndarray
    added: dict[str, int]

    def __post_init__(self):
        # For the merge loop: rank by a pair packed in one number, and the id that each rank makes.
        left, right, made = self.merges.T
        self.ranks = dict(zip((left << 32 | right).tolist(), range(len(made)), strict=True))
        self.made = made.tolist()
        # Every word begins as single bytes: the ranks of two bytes by position, which no hashing is needed for.
        self.first = [self.ranks.get(a << 32 | b, _NONE) for a in self.of_byte for b in self.of_byte]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = byte_letters()
        vocab = data["model"]["vocab"]
        added = {x["content"]: x["id"] for x in data["added_tokens"]}
        tokens = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for word, i in vocab.items():
            tokens[i] = bytes(letters[c] for c in word)
        for word, i in added.items():
            tokens[i] = word.encode()
        pairs = (m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"])
        merges = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], np.int64).reshape(-1, 3)
        return cls([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], tokens, merges, added)

    def merged(self, word: bytes) -> list[int]:
        """The ids of one pre-token: merge the pair of lowest rank, leftmost first, until none is left."""
        of_byte = self.of_byte
        ids = [of_byte[b] for b in word]
        if len(ids) > 48:
            return self._merged_long(ids)
        find, made, none, first = self.ranks.get, self.made, _NONE, self.first
        ranks = [first[x << 8 | y] for x, y in zip(word, word[1:])]
        while ranks:
            rank = min(ranks)
            if rank == none:
                break
            i = ranks.index(rank)
            del ids[i], ranks[i]
            ids[i] = one = made[rank]
            if i:
                ranks[i - 1] = find(ids[i - 1] << 32 | one, none)
            if i < len(ranks):
                ranks[i] = find(one << 32 | ids[i + 1], none)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """As ``merged`` with a heap over a linked list: n log n for a word of n bytes."""
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i):
            j = after[i] if i >= 0 else -1
            if i >= 0 and j >= 0 and (rank := self.ranks.get(ids[i] << 32 | ids[j])) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j], self.made[rank]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]


@dataclass
class _State:
    edges: dict[int, _State] = field(default_factory=dict)
    final: bool = False
    number: int = -1

    def signature(self):
        return self.final, tuple((b, id(s)) for b, s in self.edges.items())


def compile_lexicon(words: list[bytes]) -> dict[str, np.ndarray]:
    """The minimal automaton of the sorted distinct ``words`` as flat arrays.

    ``edges`` holds state * 256 + byte in order, ``targets`` the state reached, ``counts`` the words ranked before those
    that take the edge (their sum along a path is the word's rank), ``finals`` whether a word ends in a state.
    """
    root, known, previous, path = _State(), {}, b"", []

    def settle(depth: int) -> None:
        while len(path) > depth:
            parent, byte, child = path.pop()
            parent.edges[byte] = known.setdefault(child.signature(), child)

    for word in words:
        common = len(os.path.commonprefix([word, previous]))
        settle(common)
        state = path[-1][2] if path else root
        for byte in word[common:]:
            state.edges[byte] = child = _State()
            path.append((state, byte, child))
            state = child
        state.final, previous = True, word
    settle(0)

    order, stack = [], [root]
    root.number = 0
    while stack:
        state = stack.pop()
        order.append(state)
        for child in state.edges.values():
            if child.number < 0:
                child.number = 0
                stack.append(child)
    for number, state in enumerate(order):
        state.number = number
    below: dict[int, int] = {}
    pending = [root]
    while pending:  # words below each state, children first
        state = pending[-1]
        missing = [s for s in state.edges.values() if s.number not in below]
        if missing:
            pending.extend(missing)
            continue
        pending.pop()
        below[state.number] = state.final + sum(below[s.number] for s in state.edges.values())
    rows = []
    for state in order:
        passed = int(state.final)
        for byte, child in sorted(state.edges.items()):
            rows.append((state.number * 256 + byte, child.number, passed))
            passed += below[child.number]
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return {"edges": table[:, 0], "targets": table[:, 1], "counts": table[:, 2], "finals": np.array([s.final for s in order], np.int64)}


class Lexicon:
    """A compiled lexicon in a file of 64-bit numbers: part sizes, then the parts."""

    PARTS = ("edges", "targets", "counts", "finals", "starts", "ids")

    @staticmethod
    def dump(words: list[bytes], vocabulary: Vocabulary) -> bytes:
        words = sorted(set(words))
        parts = compile_lexicon(words)
        ids = [vocabulary.merged(w) for w in words]
        parts["starts"] = np.cumsum([0, *map(len, ids)]).astype(np.int64)
        parts["ids"] = np.array([i for x in ids for i in x], np.int64)
        sizes = np.array([len(parts[p]) for p in Lexicon.PARTS], np.int64)
        return b"".join(x.tobytes() for x in [sizes, *(parts[p] for p in Lexicon.PARTS)])

    def __init__(self, path: str):
        # A plain view of the mapped file: memmap's own indexing costs more than what it reads.
        mapped = np.asarray(np.memmap(path, np.int64, "r"))
        at = len(self.PARTS)
        for part, n in zip(self.PARTS, mapped[:at].tolist(), strict=True):
            setattr(self, part, mapped[at:at + n])
            at += n
        # The ids as they are joined, and where those of each word begin there.
        self.raw, self.begins = self.ids.astype("<u4").tobytes(), (self.starts * 4).tolist()

    def tokens(self, rank: int) -> bytes:
        return self.raw[self.begins[rank]:self.begins[rank + 1]]

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, -1 for words outside; all words take each step of the automaton at once."""
        rank, state = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if not len(self.edges):
            return np.full(len(words), -1)
        length = np.array([len(w) for w in words], np.int64)
        text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        start = np.cumsum(length) - length
        alive = np.arange(len(words))
        for step in range(int(length.max(initial=0))):
            ended = length[alive] <= step
            alive = alive[~ended]
            if not len(alive):
                break
            wanted = state[alive] * 256 + text[start[alive] + step]
            place = np.searchsorted(self.edges, wanted).clip(max=len(self.edges) - 1)
            known = self.edges[place] == wanted
            rank[alive[~known]] = -1
            alive, place = alive[known], place[known]
            state[alive] = self.targets[place]
            rank[alive] += self.counts[place]
        inside = (rank >= 0) & (self.finals[state] > 0)
        return np.where(inside, rank, -1)


class Encoder:
    """Encodes texts; tokens are kept as little-endian unsigned 32-bit numbers, ready to join."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.pattern = regex.compile(PATTERN)
        self.added = regex.compile("(" + "|".join(map(regex.escape, vocabulary.added)) + ")") if vocabulary.added else None
        self.known: dict[str, bytes] = {}

    def learn(self, segments: set[str]) -> None:
        """Find the tokens of segments not seen before."""
        if len(self.known) > REMEMBERED:
            # What this run uses is likely to come again; most of the rest came once.
            known = self.known
            self.known = {s: known[s] for s in segments if s in known}
        new = list(segments.difference(self.known))
        find = self.pattern.findall
        # A space and letters, here of ASCII only, are one word of the pattern.
        cut = [[s] if s[0] == " " and s.isascii() and s[1:].isalpha() else find(s) for s in new]
        # A word comes in several segments, with other punctuation; alone it is a segment too, with the same tokens.
        ids = self.known
        words = sorted({w for x in cut for w in x}.difference(ids))
        raw = [w.encode() for w in words]
        for word, bare, rank in zip(words, raw, self.lexicon.ranks(raw).tolist(), strict=True):
            if rank >= 0:
                ids[word] = self.lexicon.tokens(rank)
            else:
                found = self.vocabulary.merged(bare)
                ids[word] = pack(f"<{len(found)}I", *found)
        for segment, found in zip(new, cut, strict=True):
            if len(found) > 1:
                ids[segment] = b"".join([ids[w] for w in found])

    @staticmethod
    def segments(text: str) -> list[str]:
        """Parts that the pattern treats alone: it never joins what stands before and after a space that is followed by
        something other than white space, and such a space belongs to what follows."""
        return [s for s in _SPLIT(text) if s]

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = []
        for text in texts:
            parts = self.added.split(text) if self.added and "<" in text else [text]
            pieces.append([[p] if i % 2 else self.segments(p) for i, p in enumerate(parts)])
        special = {w: np.array([i], "<u4").tobytes() for w, i in self.vocabulary.added.items()}
        self.learn(set().union(*[p for own in pieces for p in own[::2]]))
        found = self.known.__getitem__
        return [b"".join([special[p[0]] if i % 2 else b"".join(map(found, p)) for i, p in enumerate(own)]) for own in pieces]

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """As ``encode``, in runs of texts of about RUN characters, so that few segments are held at once."""
        run, size = [], 0
        for text in texts:
            run.append(text)
            size += len(text)
            if size >= RUN:
                yield from self.encode(run)
                run, size = [], 0
        yield from self.encode(run)

    def decode(self, tokens: bytes) -> str:
        token = self.vocabulary.tokens.__getitem__
        return b"".join(map(token, np.frombuffer(tokens, "<u4").tolist())).decode("utf-8", "replace")


def frequent_words(docs: DataFrame, limit: int, text: str = "text") -> list[str]:
    """The most frequent space-separated words of all texts, without end punctuation; counted where they stand."""
    # Without this each task of the count would send ``limit`` words; at most a few million can pass, whatever the corpus.
    least = (docs.agg(F.sum(F.length(text))).first()[0] or 0) // RAREST
    words = docs.select(F.explode(F.split(F.coalesce(F.col(text), F.lit("")), " ")).alias("word"))
    counted = words.select(F.rtrim("word", F.lit(".,;:!?")).alias("word")).where("length(word) between 1 and 64").groupBy("word").count().where(F.col("count") > least)
    return [r["word"] for r in counted.orderBy(F.desc("count"), "word").limit(limit).select("word").collect()]


@dataclass
class Tokenizer:
    """What tasks need: the vocabulary's fields (of fixed size) as a broadcast, and the name of the lexicon's file.

    Plain fields, because executors need not have this package, which a broadcast object of its class would ask for.
    """

    vocabulary: object
    file: str

    def encoder(self) -> Encoder:
        """One for a task, which lets it go at its end: a Python worker that waits for its next task holds nothing."""
        return Encoder(Vocabulary(*self.vocabulary.value), Lexicon(SparkFiles.get(self.file)))


def build(docs: DataFrame, path: str, words: int = LEXICON_WORDS, text: str = "text") -> Tokenizer:
    """Compile the lexicon of ``docs`` for the tokenizer file at ``path`` and send it along with the tasks."""
    spark = docs.sparkSession
    vocabulary = Vocabulary.load(path)
    pattern = regex.compile(PATTERN)
    found = {w for word in frequent_words(docs, words, text) for form in (word, " " + word) for w in pattern.findall(form)}
    name = f"lexicon-{uuid.uuid4().hex}"
    path = f"{scratch_path(spark, 'lexicon')}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    file = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    file.write(bytearray(Lexicon.dump([w.encode() for w in found], vocabulary)))
    file.close()
    spark.sparkContext.addFile(path)  # Spark fetches it once for each executor, new ones too
    fields = (vocabulary.of_byte, vocabulary.tokens, vocabulary.merges, vocabulary.added)
    return Tokenizer(spark.sparkContext.broadcast(fields), name)


def encode_column(spark: SparkSession, tokenizer: Tokenizer, text: str = "text") -> Column:
    """The token ids of a text."""
    bound_batches(spark, BATCH_TEXT)

    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = tokenizer.encoder()
        for texts in batches:
            yield pd.Series([np.frombuffer(x, "<u4").astype("int32") for x in encoder.encode_all(list(texts))])

    return encoded(F.coalesce(F.col(text), F.lit("")))


def decode_column(spark: SparkSession, tokenizer: Tokenizer, ids: str = "ids") -> Column:
    """The text of token ids; null ids give an empty text."""
    bound_batches(spark, BATCH_TEXT)

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = tokenizer.encoder()
        for tokens in batches:
            yield pd.Series([encoder.decode(np.asarray([] if x is None else x, "<u4").tobytes()) for x in tokens])

    return decoded(F.col(ids))


def tokens_column(spark: SparkSession, tokenizer: Tokenizer, text: str = "text") -> Column:
    """Struct of the token ids and the hash of the text decoded from them, from one encoding."""
    bound_batches(spark, BATCH_TEXT)

    @F.pandas_udf("ids array<int>, decoded_sha256 string")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = tokenizer.encoder()
        for texts in batches:
            rows = [(np.frombuffer(x, "<i4"), hashlib.sha256(encoder.decode(x).encode()).hexdigest()) for x in encoder.encode_all(list(texts))]
            yield pd.DataFrame(rows, columns=["ids", "decoded_sha256"])

    return tokens(F.coalesce(F.col(text), F.lit("")))


def digest_column(spark: SparkSession, tokenizer: Tokenizer, text: str = "text") -> Column:
    """Struct of the number of tokens, the hash of the ids, and the hash of the text decoded from them."""
    bound_batches(spark, BATCH_TEXT)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digested(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = tokenizer.encoder()
        for texts in batches:
            rows = []
            for tokens in encoder.encode_all(list(texts)):
                rows.append((len(tokens) // 4, hashlib.sha256(tokens).hexdigest(), hashlib.sha256(encoder.decode(tokens).encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digested(F.coalesce(F.col(text), F.lit("")))


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op7_bpe_transducer")
def op7_bpe_transducer(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    tokenizer = build(docs, public_path())
    return docs.select("doc_id", digest_column(spark, tokenizer).alias("d")).select("doc_id", "d.*")
