"""The mix against its SQL, shares and limits, schedules and odd rows."""

import math
import random

import pytest
from compare import check, duck
from pyspark.sql import functions as F

from sitepulse.llm import mixing, queries


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_matches_sql(spark, sf):
    path = f"/root/testdata/sf{sf}"
    problem, _, _, _ = check(spark, duck(path), path, queries.op4_mixing, mixing.SQL)
    assert problem is None, problem


def _docs(spark, sizes):
    rng = random.Random(1)
    rows, n = [], 0
    for source, words in sizes.items():
        while words > 0:
            k = min(words, rng.randrange(1, 40))
            rows.append((n, " ".join(["w"] * k), source))
            words, n = words - k, n + 1
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_targets_and_limits(spark):
    sizes = {"a": 300, "b": 9000, "c": 8000, "d": 50, "e": 7000, None: 2000}
    got = mixing.report(_docs(spark, sizes))
    rows = got.collect()
    left, weights = sum(sizes.values()), dict(zip(sizes, (5, 2, 1, 5, 2, 1)))
    capped = set()
    while True:
        free = sum(w for s, w in weights.items() if s not in capped)
        new = {s for s in sizes if s not in capped and left * weights[s] / free > 3 * sizes[s]}
        if not new:
            break
        capped |= new
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
    want = {sizes[s]: 3.0 * sizes[s] if s in capped else left * weights[s] / free for s in sizes}
    taken = {}
    for r in rows:
        assert math.isclose(r.target, want[r.source_size])
        assert r.taken <= 3 * r.size and r.taken % r.size == 0
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 40 for s in taken)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, got.collect()))


def test_schedules_invert(spark):
    for schedule in (*mixing.SCHEDULES, mixing.Schedule(((0.0, 0.0), (0.3, 2.0), (0.6, 0.0), (1.0, 4.0)))):
        shares = [i / 50 for i in range(50)]
        df = spark.createDataFrame([(s,) for s in shares], "s double")
        for s, t in df.select("s", schedule.time_of(F.col("s"))).collect():
            area = 0.0
            for (t0, w0), (t1, w1) in zip(schedule.knots, schedule.knots[1:]):
                x = min(max(t - t0, 0), t1 - t0)
                area += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
            assert math.isclose(area, s * schedule.weight(), abs_tol=1e-9)
    assert [s.weight() for s in mixing.SCHEDULES] == [5.0, 2.0, 1.0]


def test_training_order_follows_schedules(spark):
    docs = _docs(spark, {"a": 6000, "b": 3000, "c": 2000})
    order = mixing.training_order(docs)
    rows = order.collect()
    assert order.columns == docs.columns
    half = len(rows) // 2
    early = [sum(r.source == s for r in rows[:half]) for s in "ac"]
    late = [sum(r.source == s for r in rows[half:]) for s in "ac"]
    assert early[0] > late[0] and early[1] < late[1]
    words = mixing.report(docs).agg(F.sum("taken")).first()[0]
    assert sum(len(r.text.split()) for r in rows) == words


def test_odd_rows(odd_documents):
    rows = mixing.report(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert {r.doc_id: r.taken for r in rows}[3] == 0
    assert mixing.training_order(odd_documents).columns == odd_documents.columns
    empty = odd_documents.limit(0)
    assert mixing.report(empty).count() == 0 and mixing.training_order(empty).count() == 0
    blank = odd_documents.filter("doc_id in (3, 4)")
    assert [r.taken for r in mixing.report(blank).collect()] == [0, 0]
