"""Links between vectors against all cosines."""

from __future__ import annotations

import numpy as np
import pytest

import millrace.llm as llm
from millrace.llm import neighbours
from tests.llm import brute

KIND = "vec_id long, embedding array<double>"


def around(rng, centre, cosine, n):
    """Vectors at a given cosine from a centre."""
    noise = rng.standard_normal((n, len(centre)))
    centre = centre / np.linalg.norm(centre)
    noise -= (noise @ centre)[:, None] * centre
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return (cosine * centre + np.sqrt(1 - cosine**2) * noise) * rng.uniform(0.1, 9, (n, 1))


def check(spark, vectors, least=1.0, **args):
    ids = [7 * i + 3 for i in range(len(vectors))]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)]
    found, recall = neighbours.link_vectors(spark.createDataFrame(rows, KIND), **args)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found.collect()}
    wanted = {ids[i]: (n, ids[c]) for i, (n, c) in enumerate(brute.linked_vectors(vectors))}
    assert sorted(got) == ids
    assert all(got[i][0] <= wanted[i][0] and got[i][1] >= wanted[i][1] for i in ids)  # no link that is not there
    total = sum(n for n, _ in wanted.values())
    assert sum(n for n, _ in got.values()) >= least * total
    if least == 1.0:
        assert got == wanted
    return recall


def test_query(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
        wanted = brute.linked_vectors([r["embedding"] for r in rows])
        got = {r["vec_id"]: r for r in llm.QUERIES["op12_nn_descent"](spark, folder).collect()}
        for row, (n, c) in zip(rows, wanted, strict=True):
            assert (got[row["vec_id"]]["n_links"], got[row["vec_id"]]["component_id"]) == (n, min(rows[c]["vec_id"], row["vec_id"]))


@pytest.mark.parametrize("block, least", [(256, 1.0), (16, 0.99)])
def test_groups_chains_and_strangers(spark, block, least, monkeypatch):
    """A hot group, groups wider than a ball, chains of links, pairs and strangers; small blocks leave the work to the descent."""
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rng = np.random.default_rng(block)
    size = 24
    parts = [rng.standard_normal((300, size)), around(rng, rng.standard_normal(size), 0.99, 200), around(rng, rng.standard_normal(size), 0.95, 60),
             around(rng, rng.standard_normal(size), 0.93, 60)]
    parts += [around(rng, rng.standard_normal(size), c, 2) for c in rng.uniform(0.94, 0.99, 40)]
    step = rng.standard_normal(size)
    for _ in range(30):
        parts.append(step[None])
        step = around(rng, step, 0.91, 1)[0]
    vectors = list(np.concatenate(parts))
    rng.shuffle(vectors)
    assert check(spark, vectors, least) >= least


def test_awkward_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal(8)
    vectors = [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, *[base] * 5, base * 1e200, base * 1e-200, -base]
    vectors += [rng.standard_normal(5), rng.standard_normal(3), [2.0], [3.0], [-1.0]]
    check(spark, vectors)


def test_empty_table_null_ids_and_repeated_rows(spark):
    empty = spark.createDataFrame([], KIND)
    assert neighbours.link_vectors(empty)[0].count() == 0
    rows = [(None, [1.0, 0.0], "x"), (None, [1.0, 0.01], "x"), (5, [1.0, 0.02], "x"), (5, [1.0, 0.02], "x"), (None, [0.0, 1.0], "x"), (9, None, "x")]
    found, _ = neighbours.link_vectors(spark.createDataFrame(rows, f"{KIND}, node string"))
    got = sorted(str(tuple(r)) for r in found.collect())
    assert got == sorted(map(str, [(5, 3, 5), (5, 3, 5), (9, 0, 9), (None, 0, None), (None, 3, 5), (None, 3, 5)]))
