from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import top_k

VECTORS = "vec_id long, embedding array<double>"


def best(rows, k, asks):
    """Integer brute force; of rows that repeat a number the smallest vector asks."""
    held = [(i, [math.floor(64 * c) for c in v]) for i, v in rows]
    out = set()
    for q in {i for i, _ in held if asks(i)}:
        own = min(v for i, v in held if i == q)
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in held if i != q)
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)}
    return out


def clustered(n, clusters, width=16, spread=0.02, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    x = centres[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, width))
    return np.floor(64 * x / np.linalg.norm(x, axis=1)[:, None])


def test_few_pairs_are_evaluated_on_clustered_vectors():
    x = clustered(8192, 40)
    pivots = top_k.spread(x[:1024], 64)
    ids, q = np.arange(len(x)), x[::20]
    room = top_k.ROOM * np.sqrt((x * x).sum(axis=1).max())
    found, pairs = top_k.search(
        ids, x.astype(np.float32), top_k.distances(x, pivots), ids[::20], q.astype(np.float32), top_k.distances(q, pivots),
        np.full(len(q), -np.inf), 20, room,
    )
    assert pairs < 0.2 * len(x) * len(q)
    scores = q @ x.T
    scores[np.arange(len(q)), ids[::20]] = -np.inf
    for i in range(len(q)):
        expect = np.lexsort((ids, -scores[i]))[:20]
        mine = found.query == i
        assert found.ids[mine].tolist() == expect.tolist()
        assert found.score[mine].tolist() == scores[i][expect].tolist()


@pytest.mark.parametrize("size", [1e5, 1e6, 1.2e7])
def test_large_components_are_exact(spark, size):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-size, size) for _ in range(4)]) for i in range(120)] + [(7, [size, 0.0, 0.0, 0.0])]
    done = top_k.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 4 == 0, k=6, block_rows=30, query_rows=10)
    assert {tuple(r) for r in done.collect()} == best(rows, 6, lambda i: i % 4 == 0)


def test_scores_beyond_long_are_an_error(spark):
    frame = spark.createDataFrame([(i, [3e8, -3e8, 1.0]) for i in range(5)], VECTORS)
    with pytest.raises(ValueError, match="64-bit"):
        top_k.top_k(frame, F.col("vec_id") == 0)


def test_a_common_vector_and_a_repeated_number(spark):
    rng = random.Random(6)
    common = [0.5, 0.25, -0.5, 0.0]
    rows = [(i, common if i % 3 == 0 else [rng.gauss(0, 0.4) for _ in range(4)]) for i in range(300)]
    rows += [(20, common)] * 40 + [(24, [rng.gauss(0, 0.4) for _ in range(4)]) for _ in range(40)]
    done = top_k.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 4 == 0, k=9, block_rows=25, query_rows=10).collect()
    found = sorted(tuple(r) for r in done)
    assert found == sorted(
        (q, rank, i, s)
        for q in {i for i, _ in rows if i % 4 == 0}
        for rank, (s, i) in enumerate(ranked(rows, q)[:9], 1)
    )


def ranked(rows, q):
    held = [(i, [math.floor(64 * c) for c in v]) for i, v in rows]
    own = min(v for i, v in held if i == q)
    scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in held if i != q)
    return [(-s, i) for s, i in scored]
