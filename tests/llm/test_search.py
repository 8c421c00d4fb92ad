"""Top-k search against SQL and against all pairs."""

import math
import random

import pytest
from compare import check, duck
from pyspark.sql import functions as F

from sitepulse.llm import queries, search


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_matches_sql(spark, sf):
    path = f"/root/testdata/sf{sf}"
    problem, _, _, _ = check(spark, duck(path), path, queries.op3_search, search.SQL)
    assert problem is None, problem


def brute(vectors, asked, k):
    out = []
    for q, v in asked:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("chunk", [7, 1000])
def test_ties_and_small_tables(spark, chunk):
    rng = random.Random(chunk)
    vectors = [(i, [rng.choice([0.0, 0.0, 0.25, -0.5]) for _ in range(6)]) for i in range(60)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    rows = search.sparse(df, "vec_id", "embedding")
    asked = rows.filter("id % 10 = 0")
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors]
    got = sorted(map(tuple, search.top_k(asked, rows, 4, chunk).collect()))
    assert got == brute(whole, whole[::10], 4)
    few = rows.filter("id < 3")
    assert search.top_k(few, few, 4, chunk).count() == 6
    assert search.top_k(few.limit(0), few, 4, chunk).count() == 0
    assert search.top_k(few, few.limit(0), 4, chunk).count() == 0


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [1.0, 2.0], "x"), (100, [0.0, 0.0], "x"), (1, None, "x"), (2, [nan, 1.0], "x"), (3, [inf, 1.0], None),
        (4, [None, 1.0], "x"), (None, [1.0, 1.0], "x"), (5, [], "x"), (6, [-1.0, 0.0], "x"), (6, [-1.0, 0.0], "x"), (0, [1.0, 2.0], "x"),
    ]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>, id string")
    rows = search.sparse(df, "vec_id", "embedding")
    got = search.top_k(rows.filter("id % 100 = 0"), rows).collect()
    assert sorted(r.vec_id for r in got if r.query_id == 0) == [5, 6, 6, 100]
    assert [r.vec_id for r in sorted(got) if r.query_id == 100] == [0, 0, 5, 6, 6]
    assert search.top_k(rows.limit(0), rows.limit(0)).count() == 0
