"""Repair of conversations by aligning their turns to the alternating grammar ``(s?(ua)+)?``.

A conversation is an ordered list of turns whose roles start with some letter.  Repairing it means choosing edits, of
least total cost, after which the letters spell one string of the grammar.  For each length that can be cheapest the turns
are aligned to the string of that length by the Wagner-Fischer recurrence.  Strings of different length share their
endings, so one table of costs over (turn, symbols still to come) serves all of them.  Only a band of that table is
filled (Ukkonen): with the cost of any repair in hand, the incumbent, a cell so far off the diagonal that the turns
to be deleted or inserted cost more cannot lie on a cheapest path.  Each length that reaches the least cost is
backtraced to its audit, the initials of its edits in order, and the ASCII-least audit wins.

A conversation of more than LONG_TURNS turns is cut into slices that different tasks work on.  There the columns of the
table are folded by what the grammar allows next (four states), which gives the same costs and audits: a slice is a small
matrix of costs between states, the matrices are folded backwards, then every slice writes its edits.

Defined cases: nulls count as one space in every column but keep null turns first; turns with equal numbers are ordered by
role, then text; a null conv_id is a conversation of its own; a conversation without turns has an empty audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, query, table
from millrace.operators.ordered import SLICE, row_index
from millrace.session import persist_table, ship_with_tasks

ship_with_tasks(__name__)

# Turns of one conversation that a task aligns with a table of its own; above that the conversation is cut into slices.
LONG_TURNS = 2_000
# Turns of a slice.
SLICE_TURNS = 50_000
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
FAR = 1 << 40

_SPACES = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
# What the grammar has seen last: nothing, the system turn, a user turn, an assistant turn.
_STATES = "-sua"
_ENDS = (True, False, False, True)


def damage(turns: DataFrame) -> DataFrame:
    """Conversations made faulty on purpose: by crc32 of ``conv_id:turn`` mod 20, 0 drops the turn, 1 empties its text, 2
    removes its ``[.!?]``, 3 repeats it, 4 makes its role user.  Nulls count as one space; other columns stay."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20
    text = F.when(F.col("__fault") == 1, "").when(F.col("__fault") == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    hurt = turns.withColumn("__fault", fault).where("__fault != 0")
    hurt = hurt.withColumns({"text": text, "role": F.when(F.col("__fault") == 4, "user").otherwise(spaced("role"))})
    copies = F.when(F.col("__fault") == 3, 2).otherwise(1)
    return hurt.withColumn("__fault", F.explode(F.array_repeat("__fault", copies))).drop("__fault")


def _marked(turns: DataFrame) -> DataFrame:
    """``__conv`` (the conv_id as text), turn, role, text, ``__shut`` (the last visible character), ``__key`` (of role and text)."""
    spaced = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = turns.select(_conversation().alias("__conv"), "turn", *spaced)
    last = F.substring(F.rtrim("text", F.lit(_SPACES)), -1, 1)
    return rows.withColumns({"__shut": last, "__key": F.md5(F.concat_ws("\0", "role", "text"))})


def _conversation() -> Column:
    """Text that names a conv_id, also a null one, so that tasks need not know its type."""
    return F.concat(F.when(F.col("conv_id").isNull(), "-").otherwise("+"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))


def faults(shut: list[str], keys: list[str]) -> list[int]:
    """The first fault of each turn, 0 if it has none."""
    seen, out = set(), []
    for end, key in zip(shut, keys, strict=True):
        out.append(BLANK if not end else DUPLICATE if key in seen else 0 if end in ".!?" else TRUNCATED)
        seen.add(key)
    return out


def _keep_cost(initial: str, symbol: str) -> int:
    """Of letting a turn stand for a symbol: 0 as it is, 1 with another role; nothing else becomes a system turn."""
    return 0 if initial == symbol else FAR if symbol == "s" else REROLE


def incumbent(initials: list[str], marks: list[int]) -> int:
    """The cost of some repair: faulty turns go, the others alternate, an odd one at the end goes too."""
    cost, symbols = 0, 0
    for i, (initial, mark) in enumerate(zip(initials, marks, strict=True)):
        if mark:
            cost += DELETE
        elif i or initial != "s":
            cost += REROLE * (initial != "ua"[symbols % 2])
            symbols += 1
    return min(cost + DELETE * (symbols % 2), DELETE * len(initials)) if symbols > 1 else DELETE * len(initials)


def _costs(initials: list[str], marks: list[int], limit: int) -> tuple[np.ndarray, int, int]:
    """Banded costs to go, ``[turns left, symbols left - turns left + low]``, of strings ``..ua`` without a system turn."""
    n = len(initials)
    low, high = limit // DELETE, limit // INSERT
    wide = low + high + 3
    costs = np.full((n + 1, wide), FAR, np.int64)
    offset = np.arange(wide) - low - 1
    insert = np.arange(wide) * INSERT
    # With no turn left the rest is inserted.
    costs[0] = np.where(offset >= 0, offset * INSERT, FAR)
    for left in range(1, n + 1):
        i = n - left
        symbols = left + offset
        delete = np.append(costs[left - 1, 1:], FAR) + DELETE
        if marks[i] in (BLANK, DUPLICATE):
            best = delete
        else:
            extra = CUT_SHORT if marks[i] else 0
            # Strings end in "a", so an odd number of symbols left starts with one.
            change = np.where(symbols % 2 == 1, _keep_cost(initials[i], "a"), _keep_cost(initials[i], "u")) + extra
            best = np.minimum(delete, costs[left - 1] + change)
        best[symbols < 0] = FAR
        if (symbols == 0).any():
            best[symbols == 0] = DELETE * left
        # Any number of insertions before this turn; each cell is reached from those with fewer symbols left.
        best = np.minimum.accumulate(best - insert) + insert
        best[(symbols < 0) | (offset == -low - 1) | (offset == high + 1)] = FAR
        costs[left] = np.minimum(best, FAR)
    return costs, low, n


def align(initials: list[str], marks: list[int]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a conversation, by alignment to every feasible length."""
    n = len(initials)
    limit = incumbent(initials, marks)
    plain, low, _ = _costs(initials, marks, limit)
    wide = plain.shape[1]

    def cost(i: int, symbols: int) -> int:
        """Of the turns from ``i`` on against the last ``symbols`` symbols."""
        at = symbols - (n - i) + low + 1
        return int(plain[n - i, at]) if 0 <= at < wide else FAR

    # A system turn in front: every turn before it is deleted.
    fronts = [(DELETE * i + (CUT_SHORT if marks[i] else 0), i) for i in range(n) if initials[i] == "s" and marks[i] in (0, TRUNCATED)]
    best, paths = FAR, []
    lengths = [m for m in range(0, n + limit // INSERT + 2, 2) if DELETE * max(0, n - m - 1) <= limit and INSERT * max(0, m - n) <= limit]
    for m in {0, *lengths}:
        found = DELETE * n if m == 0 else cost(0, m)
        led = [(found, None)] + ([(c + cost(i + 1, m), i) for c, i in fronts] if m else [])
        for total, front in led:
            if total < best:
                best, paths = total, []
            if total == best and total < FAR:
                paths.append((m, front))

    def backtrace(m: int, front: int | None) -> str:
        i, audit = 0, []
        if front is not None:
            audit, i = ["D"] * front + ["K"], front + 1
        while i < n or m:
            now = cost(i, m) if m else DELETE * (n - i)
            rest = lambda j, k: cost(j, k) if k else DELETE * (n - j)
            if i < n and rest(i + 1, m) + DELETE == now:
                audit.append("D")
                i += 1
            elif m and rest(i, m - 1) + INSERT == now:
                audit.append("I")
                m -= 1
            else:
                audit.append("K" if initials[i] == ("a" if m % 2 else "u") else "R")
                i, m = i + 1, m - 1
        return "".join(audit)

    return best, min(backtrace(*p) for p in paths)


def repaired(rows: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """The (role, text) that the edits of an audit leave of some turns."""
    rows, symbols = iter(rows), 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K" and role[:1] == "s":
            yield role, text
            continue
        yield role if edit == "K" else ("user", "assistant")[symbols % 2], text
        symbols += 1


def _sha(rows: Iterator[tuple[str, str]]) -> str:
    digest, first = hashlib.sha256(), True
    for role, text in rows:
        digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
        first = False
    return digest.hexdigest()


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


_RESULT = ["__conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_RESULT_TYPE = "__conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _short(rows: DataFrame) -> DataFrame:
    """Whole conversations, many to a task: rows come sorted and the open conversation is held."""
    def solve(part: pd.DataFrame) -> tuple:
        initials = [r[:1] for r in part["role"]]
        marks = faults(part["__shut"].tolist(), part["__key"].tolist())
        cost, audit = align(initials, marks)
        digest = _sha(repaired(zip(part["role"], part["text"], strict=True), audit))
        return part["__conv"].iloc[0], *[marks.count(k) for k in (BLANK, DUPLICATE, TRUNCATED)], _illegal(initials), cost, audit, digest

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            names = held["__conv"].to_numpy()
            edges = np.append(0, np.flatnonzero(names[1:] != names[:-1]) + 1)
            if len(edges) > 1:
                yield pd.DataFrame([solve(held.iloc[a:b]) for a, b in zip(edges, edges[1:], strict=False)], columns=_RESULT)
            held = held.iloc[edges[-1]:]
        if held is not None and len(held):
            yield pd.DataFrame([solve(held)], columns=_RESULT)

    placed = rows.repartition("__conv").sortWithinPartitions("__conv", F.col("turn").asc_nulls_first(), "role", "text")
    return placed.select("__conv", "role", "text", "__shut", "__key").mapInPandas(run, _RESULT_TYPE)


def _step(state: int, initial: str, mark: int) -> Iterator[tuple[str, int, int]]:
    """What one turn can become after ``state``: (edit, cost, next state), in ASCII order of the edits."""
    yield "D", DELETE, state
    if mark in (BLANK, DUPLICATE):
        return
    extra = CUT_SHORT if mark else 0
    if state == 0 and initial == "s":
        yield "K", extra, 1
    symbol = "a" if state == 2 else "u"
    yield ("K" if initial == symbol else "R"), _keep_cost(initial, symbol) + extra, _STATES.index(symbol)


def _inserted(state: int) -> int:
    return 3 if state == 2 else 2


def _before(turn: tuple[str, int], after: list[int]) -> list[int]:
    """Costs to go from each state before a turn, from those after it."""
    out = [min(c + after[q] for _, c, q in _step(s, *turn)) for s in range(4)]
    for _ in range(3):
        out = [min(out[s], INSERT + out[_inserted(s)]) for s in range(4)]
    return out


def _last() -> list[int]:
    out = [0 if end else FAR for end in _ENDS]
    for _ in range(3):
        out = [min(out[s], INSERT + out[_inserted(s)]) for s in range(4)]
    return out


def _walk(turns: list[tuple[str, int]], after: list[int], closing: bool) -> Iterator[tuple[str, int]]:
    """Audit and last state for each first state, given the costs to go after the turns; ``closing``: nothing follows."""
    togo = [after]
    for turn in reversed(turns):
        togo.append(_before(turn, togo[-1]))
    togo.reverse()
    for state in range(4):
        audit = []
        if togo[0][state] < FAR:
            for i, turn in enumerate(turns):
                while True:
                    now = togo[i][state]
                    delete, *others = _step(state, *turn)
                    if delete[1] + togo[i + 1][state] == now:
                        audit.append("D")
                        break
                    if INSERT + togo[i][_inserted(state)] == now:
                        audit.append("I")
                        state = _inserted(state)
                        continue
                    edit, _, state = next(x for x in others if x[1] + togo[i + 1][x[2]] == now)
                    audit.append(edit)
                    break
            while closing and not (_ENDS[state] and togo[-1][state] == 0):
                audit.append("I")
                state = _inserted(state)
        yield "".join(audit), state


def _slices(rows: DataFrame) -> DataFrame:
    """Turns of long conversations with their place, initial, first fault and slice, written once."""
    # Ascending order has nulls first.
    placed = persist_table(row_index(rows, ["__conv"], ["turn", "role", "text"], "__at"), "turns")
    seen = placed.groupBy(F.col("__conv").alias("__c"), F.col("__key").alias("__k")).agg(F.min("__at").alias("__seen"))
    seen = persist_table(seen, "seen")
    mark = (
        F.when(F.col("__shut") == "", BLANK).when(F.col("__at") > F.col("__seen"), DUPLICATE)
        .when(F.col("__shut").isin(".", "!", "?"), 0).otherwise(TRUNCATED)
    )
    marked = placed.join(seen, (F.col("__conv") == F.col("__c")) & (F.col("__key") == F.col("__k")))
    marked = marked.select("__conv", "__at", "role", "text", F.substring("role", 1, 1).alias("__initial"), mark.alias("__mark"))
    slices = -(-placed.count() // SLICE_TURNS)
    cut = marked.repartitionByRange(slices, "__conv", "__at").withColumn(SLICE, F.spark_partition_id().cast("long"))
    return persist_table(cut, "slices")


def _long(rows: DataFrame) -> DataFrame:
    """Conversations above LONG_TURNS: slices of turns, each bounded, solved in parallel and joined in order.

    The text that a hash covers passes through one task per conversation as a stream, as SHA-256 is sequential.
    """
    cut, keys = _slices(rows), ["__conv", SLICE]
    plain = cut.select(*keys, "__at", "__initial", "__mark")

    def named(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({k: part[k].tolist() for k in keys})

    def turns_of(part: pd.DataFrame) -> list[tuple[str, int]]:
        return list(zip(part["__initial"].tolist(), part["__mark"].tolist(), strict=True))

    def matrices(part: pd.DataFrame) -> pd.DataFrame:
        turns = turns_of(part.sort_values("__at"))
        costs = []
        for end in range(4):
            after = [0 if s == end else FAR for s in range(4)]
            for turn in reversed(turns):
                after = _before(turn, after)
            costs += after
        initials, marks = zip(*turns, strict=True)
        return named(part.iloc[:1]).assign(
            costs=[costs], blank=marks.count(BLANK), duplicate=marks.count(DUPLICATE), truncated=marks.count(TRUNCATED),
            illegal=_illegal(initials), head=initials[0], tail=initials[-1],
        )

    counts = "blank long, duplicate long, truncated long, illegal long, head string, tail string"
    steps = persist_table(plain.groupBy(*keys).applyInPandas(matrices, f"__conv string, {SLICE} long, costs array<long>, {counts}"), "matrices")

    def backwards(part: pd.DataFrame) -> pd.DataFrame:
        part, after, found = part.sort_values(SLICE, ascending=False), _last(), []
        for costs in part["costs"]:
            found.append(after)
            after = [min(int(costs[4 * e + s]) + after[e] for e in range(4)) for s in range(4)]
        return named(part).assign(after=found, closing=[i == 0 for i in range(len(part))], cost=after[0])

    # The folds see one row per slice, so fewer rows than turns by SLICE_TURNS.
    after = steps.select(*keys, "costs").groupBy("__conv").applyInPandas(backwards, f"__conv string, {SLICE} long, after array<long>, closing boolean, cost long")

    def walks(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("__at")
        first = part.iloc[0]
        audits, ends = zip(*_walk(turns_of(part), [int(x) for x in first["after"]], bool(first["closing"])), strict=True)
        return named(part.iloc[:1]).assign(cost=int(first["cost"]), audits=[list(audits)], ends=[list(ends)])

    walked = plain.join(after, keys).groupBy(*keys).applyInPandas(walks, f"__conv string, {SLICE} long, cost long, audits array<string>, ends array<long>")
    walked = persist_table(walked, "walks")

    def choose(part: pd.DataFrame) -> pd.DataFrame:
        part, state, states = part.sort_values(SLICE), 0, []
        for ends in part["ends"]:
            states.append(state)
            state = int(ends[state])
        return named(part).assign(state=states)

    states = walked.select(*keys, "ends").groupBy("__conv").applyInPandas(choose, f"__conv string, {SLICE} long, state int")
    audits = persist_table(walked.join(states, keys).select(*keys, "cost", "state", F.get("audits", "state").alias("audit")), "audits")

    def leave(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("__at")
        open_user = int(part["state"].iloc[0]) == 2
        rows = zip(part["role"], part["text"], strict=True)
        # A user turn that an earlier slice left open comes first, so that the roles alternate from there.
        rows = iter([("user", ""), *rows]) if open_user else rows
        lines = [f"{role}:{text}" for role, text in repaired(rows, "K" * open_user + part["audit"].iloc[0])][open_user:]
        if not lines:
            return pd.DataFrame()
        return pd.DataFrame({"__conv": part["__conv"].iloc[0], SLICE: part[SLICE].iloc[0], "n": range(len(lines)), "line": lines})

    lines = cut.select(*keys, "__at", "role", "text").join(audits.select(*keys, "state", "audit"), keys)
    lines = lines.groupBy(*keys).applyInPandas(leave, f"__conv string, {SLICE} long, n long, line string")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest = None, hashlib.sha256()
        for batch in batches:
            for name, line in zip(batch["__conv"], batch["line"], strict=True):
                if name == now:
                    digest.update(b"\n" + line.encode())
                    continue
                if now is not None:
                    yield pd.DataFrame({"__conv": [now], "repaired_sha256": [digest.hexdigest()]})
                now, digest = name, hashlib.sha256(line.encode())
        if now is not None:
            yield pd.DataFrame({"__conv": [now], "repaired_sha256": [digest.hexdigest()]})

    ordered = lines.repartition("__conv").sortWithinPartitions("__conv", SLICE, "n").select("__conv", "line")
    hashes = ordered.mapInPandas(hashed, "__conv string, repaired_sha256 string")

    w = Window.partitionBy("__conv").orderBy(SLICE)
    seam = F.concat(F.lag("tail").over(w), "head")
    seamed = steps.withColumn("illegal", F.col("illegal") + F.when(seam.isNotNull() & ~seam.isin("su", "ua", "au"), 1).otherwise(0))
    summed = seamed.groupBy("__conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    pieces = F.array_sort(F.collect_list(F.struct(SLICE, "audit")))
    joined = audits.groupBy("__conv").agg(F.max("cost").alias("cost"), F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"))
    out = summed.join(joined, "__conv").join(hashes, "__conv", "left")
    return out.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))).select(*_RESULT)


def repair(turns: DataFrame, long_turns: int = LONG_TURNS) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): gaps, counts of faults, cost, audit, hash of the repair.

    ``gaps`` counts the missing numbers between the first and the last turn.
    """
    spark = turns.sparkSession
    bound_batches(spark)
    numbers = turns.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("__n")).groupBy("conv_id").agg(
        F.sum("__n").alias("__n"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
    )
    numbers = persist_table(numbers.withColumn("__conv", _conversation()), "numbers")
    rows = _marked(turns)
    large = numbers.where(F.col("__n") > long_turns).select("__conv")
    if large.isEmpty():
        solved = _short(rows)
    else:
        solved = _short(rows.join(large, "__conv", "left_anti")).unionByName(_long(rows.join(large, "__conv", "left_semi")))
    return solved.join(numbers, "__conv").select("conv_id", "gaps", *_RESULT[1:])


@query("op13_turn_alignment")
def op13_turn_alignment(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    found = repair(damage(turns)).withColumnRenamed("conv_id", "__conv")
    # The digest has every conversation, also one of which no turn is left.
    every = turns.select("conv_id").distinct()
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    return out.select(
        "conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
