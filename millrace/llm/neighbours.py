"""Near-duplicate vectors by NN-descent, with groups of close vectors held as balls.

1. *Balls.*  Vectors are dealt in blocks of neighbours in the order of random hyperplane signs; in a block the first vector
   takes in those within half the linking angle, so that all members of a ball are linked to each other by the triangle
   inequality and need not be listed in pairs.  A few passes with other hyperplanes follow, over the leaders alone.
2. *NN-descent* over the leaders.  Each has a list of near leaders, begun in such blocks; in a round, the leaders that
   share a neighbour (in either direction) are compared, if one of them is new there, and better ones enter the lists.
   Lists are compared by sketches of one byte a component.  A list that its threshold edges fill is enlarged: these edges
   are all kept, and the places for others stay.  Candidates of a hub are dealt to several groups of bounded size.
3. *Threshold edges* are computed exactly, in double precision.  A member against another ball's leader is mostly decided
   by that angle and the ball's radius; members left undecided are compared with the other ball's undecided ones in blocks.
4. *Audit.*  The links of a bounded sample of vectors are counted against all vectors; below the wanted recall more
   blocks are dealt and the descent goes on.

Links are never wrong (each follows from cosines computed in double precision); what the descent may miss is audited.

Defined cases: vectors that are null, zero or hold null or non-finite components, link with nothing, as do vectors of
different length with each other; repeated rows are vectors of their own; a null vec_id links but never names a component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, query, table
from millrace.llm.components import components
from millrace.session import persist_table, ship_with_tasks

ship_with_tasks(__name__)

SIMILARITY = 0.9
# Vectors compared with each other in a block; passes that form balls; blockings that begin the lists.
BLOCK, PASSES, TREES = 256, 4, 3
# Places in a list for neighbours that are no threshold edges; candidates compared in one group.
PLACES, GROUP = 10, 48
# A descent ends when this share of the list entries is new, or after so many rounds.
SETTLED, ROUNDS = 0.02, 8
# Vectors whose links are counted, the share of them that must have been found, and how often the descent goes on.
AUDITED, RECALL, TRIES = 512, 0.98, 3
# Sketches err by less than this; angles are trusted up to SLACK.
MARGIN, SLACK = 0.02, 1e-6


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision."""
    rows = vectors.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def cosines(left: list, right: list) -> np.ndarray:
    """Of each pair of vectors; NaN where one is None."""
    out = np.full(len(left), np.nan)
    there = [i for i in range(len(left)) if left[i] is not None and right[i] is not None]
    for size in {len(left[i]) for i in there}:
        at = [i for i in there if len(left[i]) == size]
        a, b = (units(np.stack([side[i] for i in at])) for side in (left, right))
        out[at] = (a * b).sum(axis=1)
    return out


def _cosine(left: str, right: str) -> Column:
    @F.pandas_udf("double")
    def of(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(cosines(a.tolist(), b.tolist()))

    return of(F.col(left), F.col(right))


def _lists(table_: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and where each row's begin."""
    rows = table_[name].combine_chunks()
    rows = rows if isinstance(rows, pa.ListArray) else pa.concat_arrays(rows.chunks)
    return rows.values.to_numpy(zero_copy_only=False), rows.offsets.to_numpy()


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int | None = None) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of consecutive rows with equal keys, and the groups' edges; ``most`` cuts groups at that size."""
    held = None
    for batch in _with_end(batches):
        if batch is not None:
            fresh = pa.Table.from_batches([batch])
            held = fresh if held is None else pa.concat_tables([held, fresh]).combine_chunks()
        if held is None or not held.num_rows:
            continue
        change = np.zeros(held.num_rows, bool)
        for key in keys:
            values = held[key].to_numpy()
            change[1:] |= values[1:] != values[:-1]
        edges = np.flatnonzero(change)
        edges = np.append(0, edges[edges > 0])
        if most:
            ends = np.append(edges[1:], held.num_rows)
            edges = np.concatenate([np.arange(a, b, most) for a, b in zip(edges, ends, strict=True)])
        if batch is None:
            yield held, np.append(edges, held.num_rows)
        elif len(edges) > 1:
            yield held.slice(0, int(edges[-1])), edges
            held = held.slice(int(edges[-1])).combine_chunks()


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _signs(vec: str, seed: int) -> Column:
    """62 bits: on which side of random hyperplanes a vector lies."""
    @F.pandas_udf("long")
    def of(vectors: pd.Series) -> pd.Series:
        rows, out = vectors.tolist(), np.zeros(len(vectors), np.int64)
        sizes = np.array([len(v) for v in rows])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            planes = np.random.default_rng([seed, int(size)]).standard_normal((int(size), 62))
            sides = units(np.stack([rows[i] for i in at])) @ planes > 0
            out[at] = sides @ (1 << np.arange(62, dtype=np.int64))
        return pd.Series(out)

    return of(F.col(vec))


def _blocks(vectors: DataFrame, seed: int) -> DataFrame:
    """Vectors (node, vec, ..) in an order in which near ones are likely to be near; a task holds a range of it."""
    coded = vectors.withColumns({"dim": F.size("vec"), "code": _signs("vec", seed)})
    return coded.repartitionByRange("dim", "code", "node").sortWithinPartitions("dim", "code", "node")


def _absorb(leaders: DataFrame, seed: int, tight: float) -> DataFrame:
    """(old, new, new_vec): leaders that a block's earlier leader takes in."""
    kind = leaders.schema["vec"].dataType.simpleString()
    leaf = pa.float64() if "double" in kind else pa.float32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, edges in _whole_groups(batches, ["dim"], BLOCK):
            node = rows["node"].to_numpy()
            values, starts = _lists(rows, "vec")
            old, new, vec = [], [], []
            for a, b in zip(edges, edges[1:], strict=False):
                raw = values[starts[a]:starts[b]].reshape(b - a, -1)
                unit = units(raw)
                close, free = unit @ unit.T >= tight, np.ones(b - a, bool)
                for i in range(b - a):
                    if free[i]:
                        taken = np.flatnonzero(close[i] & free)
                        taken = taken[taken > i]
                        free[taken] = False
                        old += node[a + taken].tolist()
                        new += [int(node[a + i])] * len(taken)
                        vec += [raw[i]] * len(taken)
            if old:
                yield pa.RecordBatch.from_arrays([pa.array(old, pa.int64()), pa.array(new, pa.int64()), pa.array(vec, pa.list_(leaf))], ["old", "new", "new_vec"])

    return _blocks(leaders.select("node", "vec"), seed).select("node", "vec", "dim").mapInArrow(run, f"old long, new long, new_vec {kind}")


def balls(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, leader, vec, cos) for ``vectors`` (node, vec): members of a ball are within half the linking angle of its leader."""
    tight = math.cos(math.acos(similarity) / 2 - SLACK)
    now = persist_table(vectors.select("node", F.col("node").alias("leader"), "vec", F.lit(1.0).alias("cos")), "balls")
    for seed in range(PASSES):
        moves = persist_table(_absorb(now.where("node = leader"), seed, tight), "moves")
        if moves.isEmpty():
            break
        # Members of a leader that moves follow it if they are close enough to its new leader, else they lead themselves.
        met = now.join(moves, F.col("leader") == F.col("old"), "left").withColumn("met", _cosine("vec", "new_vec"))
        stays, goes = F.col("old").isNull(), F.col("met") >= tight
        now = persist_table(met.select(
            "node", F.when(stays, F.col("leader")).when(goes, F.col("new")).otherwise(F.col("node")).alias("leader"), "vec",
            F.when(stays, F.col("cos")).when(goes, F.col("met")).otherwise(1.0).alias("cos"),
        ), "balls")
    return now


def _begin(leaders: DataFrame, seed: int) -> DataFrame:
    """List entries (u, v, s, need) from one blocking: the nearest in the block, and all threshold edges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, edges in _whole_groups(batches, ["dim"], BLOCK):
            node, need = rows["node"].to_numpy(), rows["need"].to_numpy()
            values, starts = _lists(rows, "vec")
            for a, b in zip(edges, edges[1:], strict=False):
                unit = units(values[starts[a]:starts[b]].reshape(b - a, -1))
                near = unit @ unit.T
                np.fill_diagonal(near, -2)
                least = np.minimum(need[a:b], np.partition(near, max(0, b - a - PLACES), axis=1)[:, max(0, b - a - PLACES)])
                i, j = np.nonzero((near >= least[:, None]) & (near > -2))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (node[a + i], node[a + j], near[i, j], need[a + i])], ["u", "v", "s", "need"])

    blocks = _blocks(leaders.select("node", "vec", "need"), seed)
    return blocks.select("node", "vec", "need", "dim").mapInArrow(run, "u long, v long, s double, need double")


def _trim(entries: DataFrame) -> DataFrame:
    """The lists: each pair once, all threshold edges and the nearest PLACES others.  A pair that was there is not fresh."""
    once = entries.groupBy("u", "v", "need").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    ranked = once.withColumn("sure", F.col("s") >= F.col("need"))
    rank = F.row_number().over(Window.partitionBy("u", "sure").orderBy(F.desc("s"), "v"))
    return ranked.withColumn("rank", rank).where(F.col("sure") | (F.col("rank") <= PLACES)).drop("rank")


def _local_join(lists: DataFrame, sketches: DataFrame, turn: int) -> DataFrame:
    """Entries for the lists from comparing the neighbours, in either direction, of each leader that has a fresh one."""
    ways = lists.select(F.col("u").alias("c"), F.col("v").alias("a"), "fresh").unionAll(lists.select(F.col("v").alias("c"), F.col("u").alias("a"), "fresh"))
    met = persist_table(ways.groupBy("c", "a").agg(F.max("fresh").alias("fresh")), "met")
    sizes = met.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("groups"), F.max("fresh").alias("any")).where("any").drop("any")
    # A list is full when all its places are taken; what does not beat the last of them need not be sent.
    least = lists.groupBy(F.col("u").alias("node")).agg(F.when(F.sum((~F.col("sure")).cast("int")) >= PLACES, F.min("s")).otherwise(-2.0).alias("floor"))
    known = sketches.join(least, "node", "left").select(F.col("node").alias("a"), "sketch", "need", F.coalesce("floor", F.lit(-2.0)).alias("floor"))
    dealt = met.join(sizes, "c").withColumn("part", F.pmod(F.xxhash64("a", F.lit(turn)), F.col("groups"))).drop("groups")
    rows = dealt.join(known, "a").repartition("c", "part").sortWithinPartitions("c", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, edges in _whole_groups(batches, ["c", "part"]):
            node, fresh, floor, need = (held[x].to_numpy() for x in ("a", "fresh", "floor", "need"))
            values, starts = _lists(held, "sketch")
            u, v, s, n = [], [], [], []
            for a, b in zip(edges, edges[1:], strict=False):
                if b - a < 2 or not fresh[a:b].any():
                    continue
                x = values[starts[a]:starts[b]].reshape(b - a, -1).astype(np.float32)
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                near = x @ x.T
                new = (fresh[a:b, None] | fresh[None, a:b]) & (near > floor[a:b, None])
                np.fill_diagonal(new, False)
                i, j = np.nonzero(new)
                u.append(node[a + i]), v.append(node[a + j]), s.append(near[i, j].astype(np.float64)), n.append(need[a + i])
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (u, v, s, n)], ["u", "v", "s", "need"])

    return rows.select("c", "part", "a", "fresh", "sketch", "need", "floor").mapInArrow(run, "u long, v long, s double, need double")


def descend(leaders: DataFrame, sketches: DataFrame, lists: DataFrame | None, attempt: int) -> DataFrame:
    """Lists (u, v, need, s, fresh, sure) of ``leaders`` (node, vec, need), begun in new blocks and refined until they settle."""
    begun = [_begin(leaders, 1000 + TREES * attempt + t).withColumn("fresh", F.lit(True)) for t in range(TREES)]
    entries = begun[0]
    for more in begun[1:]:
        entries = entries.unionAll(more)
    if lists is not None:
        entries = entries.unionAll(lists.select("u", "v", "s", "need", F.lit(False).alias("fresh")))
    now = persist_table(_trim(entries), "lists")
    for turn in range(ROUNDS):
        found = _local_join(now, sketches, turn).withColumn("fresh", F.lit(True))
        now = persist_table(_trim(found.unionAll(now.select("u", "v", "s", "need", F.lit(False).alias("fresh")))), "lists")
        fresh, all_ = now.agg(F.sum(F.col("fresh").cast("long")), F.count(F.lit(1))).first()
        if (fresh or 0) <= SETTLED * all_:
            break
    return now


def _sketch(vec: str) -> Column:
    """One byte a component, scaled by the largest."""
    @F.pandas_udf("array<tinyint>")
    def of(vectors: pd.Series) -> pd.Series:
        return pd.Series([np.rint(np.asarray(v, np.float64) / np.abs(v).max() * 127).astype(np.int8) for v in vectors])

    return of(F.col(vec))


def _undecided(maybe: DataFrame, similarity: float) -> DataFrame:
    """(node, leader, other, n): links between members that the leaders' angles leave open, compared in blocks."""
    counts = maybe.groupBy(F.col("leader").alias("l"), F.col("other").alias("o")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = maybe.join(counts, (F.col("leader") == F.col("l")) & (F.col("other") == F.col("o")))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # A block holds about BLOCK members.
    blocks = dealt.groupBy("leader", "other", "block").agg(F.collect_list(F.struct("node", "vec")).alias("rows"))
    blocks = persist_table(blocks, "blocks")
    left = blocks.where("leader < other").select(F.col("leader").alias("lo"), F.col("other").alias("hi"), F.col("rows").alias("a"))
    right = blocks.where("leader > other").select(F.col("other").alias("lo"), F.col("leader").alias("hi"), F.col("rows").alias("b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo, hi, a, b in zip(batch["lo"], batch["hi"], batch["a"], batch["b"], strict=True):
                x, y = (units(np.stack([r["vec"] for r in side])) for side in (a, b))
                linked = x @ y.T >= similarity
                for side, home, other, n in ((a, lo, hi, linked.sum(axis=1)), (b, hi, lo, linked.sum(axis=0))):
                    if n.any():
                        yield pd.DataFrame({"node": [r["node"] for r in side], "leader": home, "other": other, "n": n})[n > 0]

    return left.join(right, ["lo", "hi"]).mapInPandas(run, "node long, leader long, other long, n long")


def links(members: DataFrame, leaders: DataFrame, lists: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, leader, other, n): to how many members of another ball each member is linked."""
    angle = math.acos(similarity)
    pairs = lists.where("sure").select(F.least("u", "v").alias("lo"), F.greatest("u", "v").alias("hi")).distinct()
    side = leaders.select("node", "vec", "radius", "size")
    lo, hi = (side.select(*[F.col(c).alias(f"{c}_{x}") for c in side.columns]) for x in ("lo", "hi"))
    met = pairs.join(lo, F.col("lo") == F.col("node_lo")).join(hi, F.col("hi") == F.col("node_hi")).withColumn("cos", _cosine("vec_lo", "vec_hi"))
    reach = F.cos(F.least(F.lit(math.pi), angle + F.col("radius_lo") + F.col("radius_hi") + SLACK))
    near = persist_table(met.where(F.col("cos") >= reach), "near")
    ways = [near.select(F.col(a).alias("home"), F.col(b).alias("other"), *[F.col(f"{c}_{b}").alias(f"other_{c}") for c in ("vec", "radius", "size")])
            for a, b in (("lo", "hi"), ("hi", "lo"))]
    against = members.select("node", "leader", "vec").join(ways[0].unionAll(ways[1]), F.col("leader") == F.col("home"))
    against = against.withColumn("cos", _cosine("vec", "other_vec"))
    alone = F.col("other_radius") == 0
    every = F.when(alone, F.col("cos") >= similarity).otherwise(F.col("cos") >= F.cos(angle - F.col("other_radius") - SLACK))
    none = ~alone & (F.col("cos") < F.cos(F.least(F.lit(math.pi), angle + F.col("other_radius") + SLACK)))
    judged = against.withColumn("n", F.when(every, F.col("other_size")).when(alone | none, 0))
    judged = persist_table(judged.select("node", "leader", "other", "n", F.when(F.col("n").isNull(), F.col("vec")).alias("vec")), "judged")
    all_in, maybe = judged.where("n > 0").select("node", "leader", "other", "n"), judged.where("n is null")
    # An undecided member is linked to those members of the other ball that are linked to all of its own.
    back = all_in.groupBy(F.col("other").alias("l"), F.col("leader").alias("o")).agg(F.count(F.lit(1)).alias("n"))
    owed = maybe.drop("n").join(back, (F.col("leader") == F.col("l")) & (F.col("other") == F.col("o"))).select("node", "leader", "other", "n")
    return all_in.unionAll(owed).unionAll(_undecided(maybe, similarity))


def _audit(vectors: DataFrame, counted: DataFrame, similarity: float) -> float:
    """Share of the true links of AUDITED vectors (those of least hash) that ``counted`` (node, n_links) has."""
    sample = vectors.orderBy(F.xxhash64("node"), "node").limit(AUDITED).select("node", "vec").collect()
    nodes, raw = np.array([r["node"] for r in sample]), [np.array(r["vec"]) for r in sample]
    sizes = np.array([len(v) for v in raw])
    by_size = {int(d): (nodes[sizes == d], units(np.stack([v for v in raw if len(v) == d]))) for d in np.unique(sizes)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {d: np.zeros(len(x[0]), np.int64) for d, x in by_size.items()}
        for batch in batches:
            values, starts = _lists(pa.Table.from_batches([batch]), "vec")
            wide = np.diff(starts)
            for d in np.unique(wide):
                if int(d) in by_size:
                    at = np.flatnonzero(wide == d)
                    rows = units(values[(starts[at][:, None] + np.arange(d)[None, :])])
                    total[int(d)] += (by_size[int(d)][1] @ rows.T >= similarity).sum(axis=1)
        for d, n in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(by_size[d][0]), pa.array(n)], ["node", "n"])

    true = vectors.select("vec").mapInArrow(run, "node long, n long").groupBy("node").agg((F.sum("n") - 1).alias("n"))
    both = true.join(counted, "node").agg(F.sum("n"), F.sum(F.least("n", F.coalesce("n_links", F.lit(0))))).first()
    return both[1] / both[0] if both[0] else 1.0


def link_vectors(rows: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, float]:
    """(vec_id, n_links, component_id) for each row of ``rows`` (vec_id, embedding), and the audited recall."""
    bound_batches(rows.sparkSession)
    number = F.col("embedding")
    good = (
        (F.size("embedding") > 0) & F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(number, lambda x: x != 0)
    )
    good = F.coalesce(F.when(number.isNotNull(), good), F.lit(False))
    given = persist_table(rows.select(F.monotonically_increasing_id().alias("node"), "vec_id", F.when(good, number).alias("vec")), "vectors")
    vectors = given.where("vec is not null")
    members = balls(vectors.select("node", "vec"), similarity)
    sizes = members.groupBy(F.col("leader").alias("l")).agg(
        F.count(F.lit(1)).alias("size"), F.when(F.count(F.lit(1)) > 1, F.acos(F.least(F.lit(1.0), F.min("cos")))).otherwise(0.0).alias("radius")
    )
    heads = persist_table(members.where("node = leader").join(sizes, F.col("leader") == F.col("l")).select("node", "vec", "size", "radius"), "heads")
    widest = heads.agg(F.max("radius")).first()[0] or 0.0
    need = F.cos(F.least(F.lit(math.pi), math.acos(similarity) + widest + F.col("radius"))) - MARGIN
    heads = heads.withColumn("need", need)
    sketches = persist_table(heads.select("node", _sketch("vec").alias("sketch"), "need"), "sketches")
    lists, recall = None, 0.0
    for attempt in range(TRIES):
        lists = descend(heads, sketches, lists, attempt)
        found = persist_table(links(members, heads, lists, similarity), "links")
        sums = found.groupBy("node").agg(F.sum("n").alias("more"))
        inner = members.select("node", "leader").join(heads.select(F.col("node").alias("leader"), "size"), "leader")
        counted = inner.join(sums, "node", "left").select("node", "leader", (F.col("size") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"))
        counted = persist_table(counted, "counted")
        recall = _audit(vectors, counted, similarity)
        if recall >= RECALL:
            break
    joined = components(found.select(F.col("leader").alias("a"), F.col("other").alias("b")).distinct())
    joined = joined.select(F.col("id").alias("leader"), "component")
    named = vectors.select("node", "vec_id").join(members.select("node", "leader"), "node").groupBy("leader").agg(F.min("vec_id").alias("least"))
    named = persist_table(named.join(joined, "leader", "left").select("leader", F.coalesce("component", "leader").alias("component"), "least"), "named")
    whole = named.groupBy("component").agg(F.min("least").alias("component_id"))
    whole = persist_table(named.select("leader", "component").join(whole, "component").select("leader", "component_id"), "whole")
    out = counted.join(whole, "leader").select(F.col("node").alias("n"), "n_links", "component_id")
    out = given.select("node", "vec_id").join(out, F.col("node") == F.col("n"), "left")
    alone = F.col("n").isNull()
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ), recall


@query("op12_nn_descent", """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.e, b.e) AS c FROM v a JOIN v b ON a.vec_id <> b.vec_id),
linked AS (SELECT a, b FROM links WHERE isfinite(c) AND c >= 0.9),
reach(id, root) AS (
  SELECT vec_id, vec_id FROM v
  UNION SELECT l.b, r.root FROM reach r JOIN linked l ON l.a = r.id),
named AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
SELECT v.vec_id, (SELECT count(*) FROM linked WHERE a = v.vec_id) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN named ON named.id = v.vec_id""")
def op12_nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = link_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
