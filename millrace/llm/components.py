"""Connected components of a graph that Spark holds: union-find inside tasks, then star contraction between them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import persist_table, ship_with_tasks

ship_with_tasks(__name__)


def union_find(pairs) -> dict[int, int]:
    """Node -> smallest node of its component, over the given pairs."""
    parent: dict[int, int] = {}

    def root(x):
        parent.setdefault(x, x)
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def _forest(edges: DataFrame) -> DataFrame:
    """Replace the edges of each partition by one edge from every node to the smallest node it reaches there."""

    def shrink(batches):
        found = union_find((a, b) for batch in batches for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True))
        rows = [(x, r) for x, r in found.items() if x != r]
        yield pd.DataFrame(rows, columns=["a", "b"], dtype="int64")

    return edges.mapInPandas(shrink, "a long, b long")


def _pull(pairs: DataFrame, label: str) -> DataFrame:
    """(u, v, m) where m is the smallest of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # Written first, so that the join has two plain exchanges and a node with very many edges can be split.
    return pairs.join(persist_table(least, "least"), "u")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges`` (a, b: long, not null); the component is its smallest id.

    Alternates large and small star steps until nothing changes (a number of rounds about the logarithm of the longest
    chain).  Every round is written to the shared folder, so that a lost executor costs one round at most.  Nodes
    without an edge to another node do not appear; no edges give no rows.
    """
    now = persist_table(_forest(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a != b")).distinct(), "forest")
    mark = None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _pull(both, "large").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = persist_table(large, "large")
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        pulled = _pull(down, "small")
        small = pulled.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        now = persist_table(small, "small")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    # Every edge now leads from a node to the root of its component.
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
