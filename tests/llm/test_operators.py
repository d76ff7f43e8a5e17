"""Every operator against a plain version, over test tables and over awkward rows."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import millrace.llm as llm
from millrace.llm import bpe, common, components, decontaminate, identifiers, licences, line_dedup, quality_gam, repeats, robust_rules, simhash, toxicity
from millrace.session import shared_dir
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
LONG = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix a very odd potion in the old stone tower"
ROWS = [
    (1, LONG, "en", "a", 1), (2, LONG, "en", "a", 2), (3, LONG.replace("odd", "pale"), "en", None, 3), (4, "", "en", "b", 0),
    (5, None, None, "b", None), (6, "x", "fr", "b", 1), (7, "a@b.co +1 (212) 555-0100 192.168.0.1 4111 1111 1111 1111 999.1.1.1", "en", "a", 5),
    (8, f"Intro\n{LONG}\n\n{LONG}\nReleased under the MIT License.", "en", "a", 9), (8, "another text with the same id", "en", "a", 9),
    (None, LONG, "en", "a", 4), (9, "word " * 3000, "en", "a", 5), (10, "é" * 400 + " 😀<|endoftext|>  \t\n b", "de", "c", 6), (11, "z" * 5000, "en", "a", 7),
]
KIND = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty, long and repeated texts, repeated ids, and columns named like those the operators use inside."""
    extra = {"score": F.lit(1), "row": F.lit(2), "spans": F.lit("x"), "fp": F.lit(3), "h": F.lit(4), "component": F.lit(5), "w": F.lit(6), "label": F.lit(7)}
    return spark.createDataFrame(ROWS, KIND).withColumns(extra)


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def result(spark, name):
    return {r["doc_id"]: r for r in llm.QUERIES[name](spark, FOLDER).collect()}


def test_identifiers(spark, texts):
    for i, row in result(spark, "op6_bootstrapped_identifiers").items():
        spans = brute.base_spans(texts[i])
        assert row["base_sha256"] == brute.sha(",".join(f"{brute.KINDS[k]}:{a}:{b}" for a, k, b in spans))
        assert [row[f"n_{k}"] for k in brute.KINDS] == [sum(k == s[1] for s in spans) for k in range(4)]


def test_identifiers_awkward(spark, docs):
    odd = ["1.2.3.4.5.6.7.8 0001.2.3.4", "a@b a@b.c%d@e.f.g", "4111-1111-1111-1111 5 6 7", "+1234567890 +12 +1(2)3.4-5 6789012", "\x01 4111\x0111", "9" * 3000]
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    for row in identifiers.find(docs.select("doc_id", "text").unionByName(extra)).join(extra, "doc_id").collect():
        assert [tuple(s) for s in row["base"]] == brute.base_spans(row["text"])


def test_unseen_identifiers_are_found_by_context(spark):
    rows = [(i, f"filler words here {'and' if i % 2 else 'so'} contact user{i}@mail.example.com today") for i in range(40)]
    rows += [(100, "filler words here and contact agent77 today"), (101, "chapter 12 begins")]
    found = {r["doc_id"]: r["spans"] for r in identifiers.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s["start"], s["kind"], s["end"]) for s in found[100]] == [(30, 4, 37)]
    assert not found[101]


def test_rules(spark, texts, docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for i, row in result(spark, "op5_mcd_rules").items():
        assert tuple(row[n] for n in names) == brute.rule_counts(texts[i])
        assert not (row["base_failed"] and row["kept"])
    assert robust_rules.judge(docs).count() == len(ROWS)


def test_rules_reject_far_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join("".join(rng.choice(list("abcdefgh"), int(rng.integers(2, 9)))) for _ in range(int(rng.integers(60, 300)))), "en", "s") for i in range(120)]
    rows.append((500, " ".join(f"w{i}###$$$" for i in range(100)), "en", "s"))
    kept = {r["doc_id"]: r["kept"] for r in robust_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [i for i, good in kept.items() if not good] == [500]


def test_simhash(spark, texts):
    wanted = brute.near_copies(texts)
    for i, row in result(spark, "op9_simhash_popcount").items():
        assert (int(row["fingerprint"], 16), row["component_id"]) == wanted[i]


def test_cells_miss_no_link(spark):
    rng = np.random.default_rng(1)
    prints = {int(x) for x in rng.integers(-(2**63), 2**63 - 1, 60)}
    for x in list(prints):
        for _ in range(3):
            for bit in rng.choice(63, 2, replace=False):
                prints.add(x := x ^ (1 << int(bit)))
    prints = sorted(prints)
    rows = spark.createDataFrame(list(enumerate(prints)), "id long, fp long")
    wanted = {(a, b) for b in range(len(prints)) for a in range(b) if ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= 2}
    assert {(min(r), max(r)) for r in simhash.links(rows).collect()} == wanted


def test_keep_one(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert 1 in ids and 2 not in ids and ids.count(8) == 2  # id 8 names two texts that are no copies


def test_components(spark):
    pairs = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7)] + [(200, 200 + i) for i in range(1, 30)]
    found = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, **{200 + i: 200 for i in range(30)}}


def test_lines(spark, texts):
    wanted = brute.removed_lines(texts)
    for i, row in result(spark, "op2_line_minhash").items():
        assert [int(x) for x in row["removed"].split(",") if x] == wanted[i]


def test_lines_awkward(docs):
    out = line_dedup.dedup(docs)
    assert out.columns == [*docs.columns, "__removed"] and out.count() == len(ROWS)
    by_id = {(r["doc_id"], r["source"]): r["text"] for r in out.collect() if r["doc_id"] not in (8, None)}
    assert by_id[5, "b"] is None and by_id[2, "a"] == ""


def test_repeats(spark, texts):
    wanted = brute.repeats(texts)
    for i, row in result(spark, "op4_induced_suffix_repeats").items():
        assert (row["n_bytes"], row["n_removed"], row["n_spans"], row["kept_sha256"]) == wanted[i]


def test_repeats_awkward(docs):
    out = {(r["doc_id"], r["text"]): bytes(r["kept"]) for r in repeats.remove_repeats(docs).collect()}
    assert len(out) == len(ROWS) and out[1, LONG] == LONG.encode() and out[2, LONG] == b"" and out[None, LONG] == LONG.encode()
    assert out[11, "z" * 5000] == b"z" * 5000


@pytest.mark.parametrize("seed", range(30))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    text = np.append(np.tile(rng.integers(2, 3 + seed % 5, int(rng.integers(1, 60))), 1 + seed % 4), 0)
    values = text.tolist()
    wanted = sorted(range(len(values)), key=lambda i: values[i:])
    array = repeats.suffix_array(text)
    assert array.tolist() == wanted
    shared = repeats.common_prefixes(text, array)
    for a, b in zip(wanted, wanted[1:], strict=False):
        n = next(k for k in range(len(values)) if values[a + k] != values[b + k])
        assert shared[b] == n


def test_tokens(spark, texts, docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(bpe.public_path())
    found = result(spark, "op7_bpe_transducer")
    odd = bpe.build(docs, bpe.public_path(), words=20)
    tried = docs.select(F.coalesce("text", F.lit("")).alias("t"), bpe.encode_column(spark, odd).alias("ids")).withColumn("back", bpe.decode_column(spark, odd))
    for row in tried.collect():
        assert row["ids"] == own.encode(row["t"], add_special_tokens=False).ids and row["back"] == row["t"]
    for i, text in texts.items():
        ids = own.encode(text, add_special_tokens=False).ids
        assert (found[i]["n_tokens"], found[i]["ids_sha256"]) == (len(ids), brute.sha(np.array(ids, "<u4").tobytes()))
        assert found[i]["decoded_sha256"] == brute.sha(own.decode(ids, skip_special_tokens=False))


def test_transducer():
    words = sorted({b"tap", b"taps", b"top", b"tops", b"stop", b"stops", "é".encode()})
    parts = bpe.compile_lexicon(words)
    lexicon = bpe.Lexicon.__new__(bpe.Lexicon)
    vars(lexicon).update(parts)
    assert lexicon.ranks(words).tolist() == list(range(len(words)))
    assert lexicon.ranks([b"", b"t", b"ta", b"tapss", b"zzz", b"sto"]).tolist() == [-1] * 6
    assert len(parts["finals"]) < sum(map(len, words))  # endings are shared


def test_decontamination_both_plans(spark, docs):
    items = spark.createDataFrame([(1, LONG), (2, "x"), (2, "x"), (3, None), (4, ""), (None, "another text")], "item_id long, text string")
    wanted = None
    for limit in ("100000", "0"):
        spark.conf.set("spark.millrace.broadcastRows", limit)
        rows = sorted(map(repr, decontaminate.judge(docs.select("doc_id", "text"), items).drop("row").collect()))
        assert len(rows) == len(ROWS) and wanted in (None, rows)
        wanted = rows
    spark.conf.unset("spark.millrace.broadcastRows")
    kept = decontaminate.keep_clean(docs, items)
    assert kept.columns == docs.columns and {1, 2, 6}.isdisjoint({r["doc_id"] for r in kept.collect()})


def test_classifiers_learn(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = llm.QUERIES["op10_quality_gam"](spark, folder).join(labels, "doc_id").where("held_out").toPandas()
    assert (found["predicted"] == found["quality"]).mean() > 0.97
    found = llm.QUERIES["op1_toxicity_ordinal"](spark, folder).drop("toxic").join(labels, "doc_id").where("held_out").toPandas()
    assert (found["predicted"] == found["toxic"]).mean() > 0.9 and found[found["toxic"] == 0]["predicted"].mean() < 0.03
    assert (found["severity"] >= found["p_mild"]).all() and (found["p_mild"] >= found["p_severe"]).all()


def test_classifiers_awkward(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (9, 0, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        kept = quality_gam.keep_good(docs, quality_gam.train(docs, labels), 0.0)
        assert kept.columns == docs.columns and kept.count() == len(ROWS)
        assert docs.select(toxicity.severity_column(spark, toxicity.train(docs, labels)).alias("p")).where("size(p) = 2").count() == len(ROWS)


def test_licences(spark, docs):
    found = {r["doc_id"]: r["found"] for r in licences.scan(docs.where("source = 'a' and n_chars = 9 and text like 'Intro%'").select("doc_id", "text"), licences.train(docs.select("doc_id", "text"))).collect()}
    assert [(x["line"], x["family"]) for x in found[8]] == [(4, "MIT")]
    for r in llm.QUERIES["op8_licence_classifier"](spark, FOLDER).collect():
        assert r["n_licences"] == (len(r["lines"].split(",")) if r["lines"] else 0)


def test_empty_tables(spark, docs):
    empty = docs.where("false").select("doc_id", "text", "lang", "source")
    items = spark.createDataFrame([], "item_id long, text string")
    for out in (
        identifiers.find(empty), robust_rules.judge(empty), simhash.near_copies(empty), simhash.keep_one(empty), line_dedup.dedup(empty),
        repeats.remove_repeats(empty), decontaminate.judge(empty, items), licences.scan(empty, licences.train(empty)),
        empty.select(bpe.encode_column(spark, bpe.build(empty, bpe.public_path()))),
    ):
        assert out.count() == 0
    assert decontaminate.judge(docs.select("doc_id", "text"), items).where("n_items > 0").count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, FOLDER)
        assert kept.columns == docs.columns
        kept = spark.createDataFrame(kept.toPandas(), docs.schema)
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert set(rows) == {r["doc_id"] for r in kept.collect()}
    assert all(rows[r["doc_id"]]["decoded_sha256"] == brute.sha(r["text"]) for r in kept.collect())


def test_rules_reject_moderate_outliers(spark):
    rng = np.random.default_rng(3)

    def prose(n):
        return ["".join(rng.choice(list("abcdefgh"), int(rng.integers(2, 9)))) for _ in range(n)]

    rows = [(i, " ".join(prose(int(rng.integers(80, 200)))), "en", "s") for i in range(200)]
    rows.append((500, " ".join(w + "#" * (i % 10 == 0) for i, w in enumerate(prose(120))), "en", "s"))  # 10 symbols per 100 words
    rows.append((501, " ".join([*prose(72), *(["one", "more", "time"] * 16)]), "en", "s"))  # 40 of 100 words in repeated triples
    rows.append((502, " ".join(prose(4000)), "en", "s"))  # 30 times too long
    kept = {r["doc_id"]: r["kept"] for r in robust_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert sorted(i for i, good in kept.items() if not good) == [500, 501, 502]


def test_lines_of_repeated_shingles_are_similar_at_any_length(spark):
    texts = {1: "-" * 10, 2: "-" * 80, 3: "ha " * 4, 4: "ha " * 27}
    out = line_dedup.dedup(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    wanted = brute.removed_lines(texts)
    assert {r["doc_id"]: r["__removed"] or [] for r in out} == wanted and wanted[2] == [0]


def test_near_copies_that_are_not_similar_do_not_all_meet(spark, monkeypatch):
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(60)]
    texts = {}
    for i in range(200):  # copies of one line with 4 words of their own (similarity about 0.57); the last 20 are near the first 20
        own = list(texts[i - 180].split() if i >= 180 else words)
        for k in rng.choice(60, 1 if i >= 180 else 4, replace=False):
            own[k] = "".join(rng.choice(list("nopqrstu"), 5))
        texts[i] = " ".join(own)
    listed, found = [], line_dedup._similar

    def similar(pairs, lines):
        listed.append(pairs.count())
        return found(pairs, lines)

    monkeypatch.setattr(line_dedup, "_similar", similar)
    out = line_dedup.dedup(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["__removed"] or [] for r in out} == brute.removed_lines(texts)
    assert sum(listed) < 200 * 199 // 2 // 5


def test_prefixes_of_similar_lines_agree():
    rng = np.random.default_rng(5)
    base = "".join(rng.choice(list("abcd "), 300))
    texts = [base, base[:270], base + "xyz" * 9, "-" * 10, "-" * 80, "short", "", "tiny"]
    counts = rng.integers(0, 3, 64)
    rows = line_dedup.prefixes(texts, counts)
    tokens = {i: dict(zip(x["token"], x["ahead"], strict=True)) for i, x in rows.groupby("text")}
    size = dict(zip(rows["text"], rows["size"], strict=True))
    sets = [brute.shingles(x) for x in texts]
    assert [size[i] for i in range(len(texts))] == [len(x) for x in sets]
    for a in range(len(texts)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                shared = tokens[a].keys() & tokens[b].keys()
                assert any(9 * min(tokens[a][t], tokens[b][t]) >= 4 * (size[a] + size[b]) for t in shared)


def test_clean_rows_stay_beside_contaminated_ones_of_their_id(spark):
    rows = [(None, LONG, 1), (None, "some clean text", 2), (5, f"{LONG} and more", 3), (5, "another clean text", 4), (6, LONG, 5)]
    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    kept = decontaminate.keep_clean(spark.createDataFrame(rows, "doc_id long, text string, n int"), items)
    assert sorted(r["n"] for r in kept.collect()) == [2, 4]


def test_rows_without_id_link_others(spark):
    prints = [(7, 0b0), (None, 0b11), (3, 0b1111), (None, 0xFF << 40), (None, 0x7F << 40), (9, 0x0FF0FF0FF)]
    found = {r["fp"]: r["component"] for r in simhash.classes(spark.createDataFrame(prints, "doc_id long, fp long")).collect()}
    assert found == {0: 3, 0b11: 3, 0b1111: 3, 0xFF << 40: None, 0x7F << 40: None, 0x0FF0FF0FF: 9}


def test_keep_one_of_near_copies_without_id(spark, monkeypatch):
    monkeypatch.setattr(simhash, "fingerprint_column", lambda spark: F.col("text").cast("long"))
    rows = [(None, "1"), (None, "3"), (None, "240"), (4, "241"), (4, "4080"), (4, "4081")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in kept} == {None, 4} and len(kept) == 3


def test_varied_notices_do_not_raise_the_cut(spark):
    rows = [(i, f"Package{i} by author{i} is available under the MIT License.") for i in range(80)]
    rows += [(100 + i, f"The story{i} of the house{i} under the hill{i} and the licence of the public road{i}.") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: [x["family"] for x in r["found"]] for r in licences.scan(docs, licences.train(docs)).collect()}
    assert all(found[i] == ["MIT"] for i in range(80)) and not any(found[100 + i] for i in range(200))


def test_wrapped_notices_are_found_once(spark):
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License"
    tail = "Licensed under the Apache\nLicense, Version 2.0.\nReleased under the MIT License."
    rows = [(1, f"first line\n{gpl}\n\nmore words"), (2, gpl.replace("\n# ", " ")), (3, f"{tail}\n{gpl}"), (4, "the terms of\nthe house")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: [(x["line"], x["last"], x["family"]) for x in r["found"]] for r in licences.scan(docs, licences.train(docs)).collect()}
    assert found == {1: [(1, 2, "GPL")], 2: [(0, 0, "GPL")], 3: [(0, 1, "Apache-2.0"), (2, 2, "MIT"), (3, 4, "GPL")], 4: []}


def test_tokens_of_single_words_are_remembered_once(tmp_path):
    from tokenizers import Tokenizer

    vocabulary = bpe.Vocabulary.load(bpe.public_path())
    (tmp_path / "lexicon").write_bytes(bpe.Lexicon.dump([b" the", b"the"], vocabulary))
    encoder = bpe.Encoder(vocabulary, bpe.Lexicon(str(tmp_path / "lexicon")))
    assert type(encoder.lexicon.edges) is np.ndarray
    texts = ["the the qzxv, qzxv. it's  12\n\n x", " é\u00a0ab <|endoftext|>", "'sx ''s " + "ab" * 40, ""]
    own = Tokenizer.from_file(bpe.public_path())
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder.known[" the"] == encoder.lexicon.tokens(0) and not hasattr(encoder, "words")


def test_encoder_keeps_what_the_run_uses_and_no_more(tmp_path, monkeypatch):
    vocabulary = bpe.Vocabulary.load(bpe.public_path())
    # Pairs as numbers, not as objects of which every Python worker would hold fifty thousand.
    assert type(vocabulary.merges) is np.ndarray and len(vocabulary.merges) == len(vocabulary.ranks)
    (tmp_path / "lexicon").write_bytes(bpe.Lexicon.dump([], vocabulary))
    encoder = bpe.Encoder(vocabulary, bpe.Lexicon(str(tmp_path / "lexicon")))
    expected = encoder.encode(["a qzxv b", "a qzxv c", "ab" * 40])
    monkeypatch.setattr(bpe, "REMEMBERED", 2)
    kept = encoder.known[" qzxv"]
    assert encoder.encode(["a qzxv c"]) == expected[1:2]
    assert encoder.known[" qzxv"] is kept and set(encoder.known) == {"a", " qzxv", " c"}
    assert encoder.encode(["a qzxv b", "a qzxv c", "ab" * 40]) == expected


def test_only_suffixes_not_told_apart_are_sorted_again(monkeypatch):
    rng = np.random.default_rng(5)
    values = np.concatenate([np.arange(10, 74), rng.permutation(4000) + 100, np.arange(10, 74), [5]])
    names = np.searchsorted(np.sort(values), values)
    sizes = []

    def counted(function):
        return lambda x, *a, **b: sizes.append(len(x)) or function(x, *a, **b)

    for name in ("argsort", "unique"):
        monkeypatch.setattr(np, name, counted(getattr(np, name)))
    ranks = repeats.rank_by_doubling(names)
    monkeypatch.undo()
    suffixes = sorted(range(len(values)), key=lambda i: values[i:].tolist())
    assert np.argsort(ranks).tolist() == suffixes
    assert 0 < sum(sizes) < 1000


@pytest.mark.parametrize("seed", range(4))
def test_repeated_ranges_of_pieces(seed):
    rng = np.random.default_rng(seed)
    source = rng.integers(97, 99 + 8 * (seed % 2), 400).astype(np.uint8).tobytes()
    cuts = [(int(a), int(a) + int(n)) for a, n in zip(rng.integers(0, 250, 12), rng.integers(1, 150, 12), strict=True)]
    pieces, docs = [source[a:b] for a, b in cuts], rng.integers(0, 5, 12)
    first: dict[bytes, int] = {}
    for piece, doc in zip(pieces, docs.tolist(), strict=True):
        for i in range(len(piece) - 49):
            first[piece[i:i + 50]] = min(doc, first.get(piece[i:i + 50], doc))
    for piece, doc, found in zip(pieces, docs.tolist(), repeats.repeated_ranges(pieces, docs), strict=True):
        covered = {k for i in range(len(piece) - 49) if first[piece[i:i + 50]] < doc for k in range(i, i + 50)}
        assert {k for a, b in found for k in range(a, b)} == covered


def test_anchors_in_runs_of_documents(monkeypatch):
    class Frame:
        def mapInPandas(self, function, schema):
            return function

    rng = np.random.default_rng(3)
    texts = ["", "short", *("".join(rng.choice(list("abé "), int(n))) for n in rng.integers(0, 400, 40)), ""]
    batch = pd.DataFrame({"doc_id": range(len(texts)), "same": range(len(texts)), "text": texts})
    found = []
    for run in (1, 700, 1 << 30):
        monkeypatch.setattr(repeats, "RUN", run)
        found.append(pd.concat(repeats.anchor_rows(Frame())(iter([batch, batch[:0]]))).values.tolist())
    assert found[0] and found[0] == found[1] == found[2]


def test_cells_are_not_broadcast(spark):
    pairs = simhash.links(spark.createDataFrame([(1, 0b1), (2, 0b11), (3, 0xFF << 20)], "id long, fp long"))
    assert {tuple(sorted(r)) for r in pairs.collect()} == {(1, 2)}
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_bands_and_tokens_are_not_broadcast(spark, monkeypatch):
    plans = {}

    def written(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return df

    monkeypatch.setattr(line_dedup, "persist_table", written)
    members = spark.createDataFrame([(1, True, 1, LONG), (2, True, 2, LONG + "!"), (3, True, 3, "z" * 50)], "cid long, apart boolean, c long, norm string")
    pairs = line_dedup.rare_pairs(members)
    assert [tuple(r) for r in pairs.collect()] == [(1, 2)]
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    line_dedup.line_components(line_dedup.lines_of(spark.createDataFrame([(1, LONG), (2, LONG + "!")], "doc_id long, text string")))
    assert "Broadcast" not in plans["paired"]


@pytest.mark.parametrize("rows", [7, 50_000])
def test_strings_shared_at_the_edges_of_documents(spark, monkeypatch, rows):
    monkeypatch.setattr(common, "BATCH_ROWS", rows)
    rng = np.random.default_rng(9)

    def filler(n):
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), n))

    shared = [filler(n) for n in (34, 49, 50, 50, 51, 66, 90)]
    texts = {}
    for i in range(60):
        s = shared[i % 7]
        texts[i] = [s, s + filler(40), filler(40) + s, filler(17) + s + filler(17), filler(5) + s + filler(90) + s][i % 5]
    out = repeats.remove_repeats(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    wanted = brute.repeats(texts)
    assert {r["doc_id"]: (len(r["text"]), len(r["text"]) - len(r["kept"]), len(r["spans"]), brute.sha(bytes(r["kept"]))) for r in out} == wanted
    assert sum(w[1] for w in wanted.values()) > 1000


def test_anchors_of_short_shared_strings_are_dropped(spark):
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 300)) for _ in range(20)]
    texts = [t[:140] + "a phrase of thirty bytes here " + t[170:] for t in texts] + [texts[0][:100] + texts[1][:100]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("same", F.xxhash64("text")).coalesce(1)
    assert {r["doc_id"] for r in repeats.shared_anchors(repeats.anchor_rows(rows)).collect()} <= {0, 1, 20}


def test_repeats_leave_one_table_and_no_shuffle_files(spark):
    def files():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        found = manager.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    scratch = f"{shared_dir(spark).removeprefix('file://')}/millrace/{spark.sparkContext.applicationId}"
    tables, old = set(os.listdir(scratch)) if os.path.isdir(scratch) else set(), files()
    texts = [(i, LONG * (1 + i % 3) + "x" * i) for i in range(30)]
    found = repeats.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string"))
    left = set(os.listdir(scratch)) - tables
    assert [x.split("-")[0] for x in left] == ["gone"]
    # The bytes of the pieces are added up by a query of two shuffles that writes no table.
    assert len({x.split("_")[1] for x in files() - old}) <= 2
    assert found.where("octet_length(kept) < octet_length(text)").count() == 29
