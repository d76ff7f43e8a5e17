"""Repair of conversations against trying all edits."""

from __future__ import annotations

import random

import numpy as np
import pytest

import millrace.llm as llm
from millrace.llm import turns
from tests.llm import brute

COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def by_conversation(rows):
    out = {}
    for conv, *turn in rows:
        out.setdefault(conv, []).append(tuple(turn))
    return out


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = by_conversation(brute.damaged(rows))
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in llm.QUERIES["op13_turn_alignment"](spark, folder).collect()}
    assert got == {conv: brute.repair(left.get(conv, [])) for conv in {r[0] for r in rows}}


def made(seed: int, n: int) -> list[tuple]:
    rnd = random.Random(seed)
    texts = ["Fine.", "Good!", "cut short", "", " \n", "Why?", "And then. ", "one,"]
    if seed % 2:
        texts += [f"Turn {i}." for i in range(40)]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "s"]
    return [(rnd.choice([None, *range(n)]), rnd.choice(roles[: rnd.choice([2, 4, 8])]), rnd.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("long_turns", [2000, 6])
def test_awkward_conversations(spark, long_turns, monkeypatch):
    """Also with slices of a few turns: the same costs, audits and hashes."""
    monkeypatch.setattr(turns, "SLICE_TURNS", 7)
    rows = [(None if conv == 3 else conv, *t) for conv in range(60) for t in made(conv, conv % 14)]
    rows += [(1 << 60, *t) for t in made(101, 90)] + [((1 << 60) + 1, *t) for t in made(7, 60)] + [(500, 1, "user", "")] * 9
    rows += [(501, i, ("user", "assistant")[i % 2], f"Turn {i}." + "long " * 20_000 + ".") for i in range(8)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in turns.repair(df, long_turns).collect()}
    assert got == {conv: brute.repair(t) for conv, t in by_conversation(rows).items()}


def test_nulls_empty_table_and_clashing_names(spark):
    kind = "conv_id long, turn long, role string, text string, cost string, __conv int, audit int"
    empty = spark.createDataFrame([], kind)
    assert turns.repair(turns.damage(empty)).count() == 0
    rows = [(None, None, None, None, "x", 1, 2), (1, None, "user", None, "x", 1, 2), (1, 1, None, "Hi.", None, None, None), (2, 5, "user", "Hi.", "x", 1, 2)]
    damaged = turns.damage(spark.createDataFrame(rows, kind))
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in turns.repair(damaged).collect()}
    assert got == {conv: brute.repair(t) for conv, t in by_conversation(brute.damaged([r[:4] for r in rows])).items()}


@pytest.mark.parametrize("seed", range(40))
def test_alignment_and_states_agree(seed):
    """The table over all lengths and the folded states of long conversations give one audit."""
    rng = np.random.default_rng(seed)
    n = int(rng.integers(0, 120))
    initials = [("s", "u", "a", "t", "")[i] for i in rng.integers(0, 5 if seed % 3 else 3, n)]
    marks = [int(x) for x in rng.choice([0, 1, 2, 3], n, p=[0.7, 0.1, 0.1, 0.1])]
    cost, audit = turns.align(initials, marks)
    walked, _ = next(iter(turns._walk(list(zip(initials, marks, strict=True)), turns._last(), True)))
    assert audit == walked and cost <= turns.incumbent(initials, marks)


def test_a_long_conversation_in_reasonable_time():
    cost, audit = turns.align(["u", "a"] * 1000, [0, 0, 3, 0, 1] * 400)
    assert len(audit.replace("I", "")) == 2000 and cost > 0
