"""Phrases against counting all of them."""

from __future__ import annotations

import random

import pytest

import millrace.llm as llm
from millrace.llm import phrases
from tests.llm import brute

KIND = "lang string, text string"


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()]
    got = sorted(map(tuple, llm.QUERIES["op11_phrase_stripes"](spark, folder).collect()))
    assert got == sorted(brute.phrases(rows, 100, 2000)) and len(got) > 20


def made(seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "é", "ω x", "d\u0001", "#1", "A", "the", "the"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "\x0c", "!?", " ; "]
    text = lambda: "".join(rnd.choice(words) + rnd.choice(marks) for _ in range(rnd.randrange(120)))
    return [(rnd.choice(["en", "en", None, "", "de"]), text()) for _ in range(60)] + [("en", None), (None, ""), ("fr", " . "), ("en", "the the the the the the the")] * 3


@pytest.mark.parametrize("window, held, parts", [(4 << 20, 2_000_000, 8), (16, 50, 3)])
def test_awkward_texts(spark, monkeypatch, window, held, parts):
    """Also with windows of a few bytes and tasks that send after a few counts."""
    monkeypatch.setattr(phrases, "WINDOW", window)
    monkeypatch.setattr(phrases, "HELD", held)
    for seed in range(2):
        rows = made(seed)
        docs = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], f"{KIND}, n int, phrase string").repartition(parts)
        got = sorted(map(tuple, phrases.collocations(docs, 4, 25).collect()))
        assert got == sorted(brute.phrases(rows, 4, 25))


def test_long_text_ties_and_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], KIND)).count() == 0
    rows = [("en", "one two three four five six " * 40_000), ("en", "x" * 300_000 + " y"), ("de", "a b. c d. " * 200)]
    got = sorted(map(tuple, phrases.collocations(spark.createDataFrame(rows, KIND)).collect()))
    assert got == sorted(brute.phrases(rows, 100, 2000))


def test_a_bitmap_that_is_too_small_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_BITS", 1 << 6)
    monkeypatch.setattr(phrases, "BITS_EACH", 1)
    rows = made(3)
    got = sorted(map(tuple, phrases.collocations(spark.createDataFrame(rows, KIND), 3, 40).collect()))
    assert got == sorted(brute.phrases(rows, 3, 40))


def test_stripes_need_one_shuffle(spark):
    docs = spark.createDataFrame(made(1), KIND).fillna("", ["text"])
    plan = phrases.stripes(docs, (2,))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
