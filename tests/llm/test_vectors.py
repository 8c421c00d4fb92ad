"""Embedding links against all pairs, recall at the threshold, odd vectors."""

import brute
import numpy as np
import pytest
from compare import check, duck

from sitepulse.llm import buckets, queries, vectors


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_matches_sql(spark, sf):
    path = f"/root/testdata/sf{sf}"
    problem, _, _, _ = check(spark, duck(path), path, queries.op1_vectors, vectors.SQL)
    assert problem is None, problem


def expected(rows):
    def usable(v):
        return v is not None and None not in v and np.isfinite(v).all() and np.linalg.norm(v) > 0

    def linked(a, b):
        (_, v, x), (_, w, y) = rows[a], rows[b]
        if x is None or x != y or not usable(v) or not usable(w) or len(v) != len(w):
            return False
        v, w = np.array(v, float), np.array(w, float)
        return bool(v @ w >= 0.93 * np.linalg.norm(v) * np.linalg.norm(w))

    at = range(len(rows))
    links = [sum(linked(a, b) for b in at if a != b) for a in at]
    comp = brute.components(at, linked)
    least = {}
    for a in at:
        if rows[a][0] is not None:
            least[comp[a]] = min(rows[a][0], least.get(comp[a], rows[a][0]))
    return sorted(
        ((k, n, least.get(comp[a]), k is not None and k == least.get(comp[a])) for a, (n, (k, _, _)) in enumerate(zip(links, rows))),
        key=str,
    )


@pytest.mark.parametrize("block", [4096, 16])
def test_clusters(spark, block, monkeypatch):
    rng = np.random.default_rng(block)
    rows = []
    for c in range(12):
        centre = rng.normal(size=24)
        for _ in range(25):
            rows.append((len(rows), (centre + rng.normal(size=24) * rng.uniform(0.05, 0.35)).tolist(), c % 2))
    rows += [(len(rows) + i, rows[0][1], 0) for i in range(30)]
    rows.append((0, rows[0][1], 0))
    monkeypatch.setattr(buckets.blocks, "__defaults__", (block,))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert sorted(map(tuple, vectors.near_duplicates(df).collect()), key=str) == expected(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], 1), (2, [2.0, 4.0], 1), (3, [2.0, 4.0], 2), (4, [2.0, 4.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
        (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [None, 1.0], 1), (12, [1.0], 1),
        (13, [], 1), (None, [1.0, 2.0], 1), (None, [5.0, -1.0], 1), (1, [1.0, 2.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert sorted(map(tuple, vectors.near_duplicates(df).collect()), key=str) == expected(rows)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_recall_at_the_threshold():
    """Pairs just at the threshold in 64 dimensions meet in some bucket."""
    rng = np.random.default_rng(3)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b
    met = (vectors.probes(a)[:, :, :, None] == vectors.probes(b)[:, :, None, :]).any((1, 2, 3))
    assert met.mean() >= 0.98
