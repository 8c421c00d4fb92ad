"""Whitening against numpy's singular vectors of all rows; odd and badly conditioned vectors."""

import numpy as np
import pytest

from sitepulse.llm import queries, whitening

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
KIND = "vec_id bigint, embedding array<double>, label int"


def expected(rows, components=32):
    """{vec_id: (deviation, whitened up to the sign of a component)}, explained."""
    x = np.array([np.floor(64 * np.array(v, float)) + 1_000_000 for _, v in rows]).astype(np.int64)
    n, total = len(x), x.sum(axis=0)
    apart = n * x - total
    centred = apart / n
    # Singular vectors of the rows themselves, which keep the digits that a covariance loses.
    _, spread, turned = np.linalg.svd(centred, full_matrices=False)
    values, axes = spread[:components] ** 2 / n, turned[:components].T
    white = centred @ axes / np.sqrt(values)
    return [sum(int(a) ** 2 for a in row) for row in apart], white, values / (centred**2).sum() * n


def compared(got, rows, components=32, tolerance=1e-6):
    deviations, white, explained = expected(rows, components)
    by_key = {}
    for r in got:
        by_key.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(by_key) == sorted(k for k, _ in rows)
    size = white.shape[1]
    signs = None
    for at, (key, _) in enumerate(rows):
        found = by_key[key]
        assert sorted(found) == list(range(1, size + 1))
        line = np.array([found[c].whitened for c in range(1, size + 1)])
        signs = np.where(np.abs(line - white[at]) < np.abs(line + white[at]), 1, -1) if signs is None else signs
        assert np.abs(line * signs - white[at]).max() < tolerance
        assert {r.deviation for r in found.values()} == {deviations[at] if deviations[at] < 1 << 63 else None}
        assert {r.n for r in found.values()} == {len(rows)}
    shares = np.array([by_key[rows[0][0]][c].explained for c in range(1, size + 1)])
    assert np.abs(shares / explained - 1).max() < 1e-9
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_query_matches_numpy(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding) for r in given if r.embedding is not None and None not in r.embedding and np.isfinite(r.embedding).all()]
    got = queries.op13_whitening(spark, sf_dir)
    assert got.columns == COLUMNS
    compared(got.collect(), rows)


def test_badly_conditioned_rows(spark):
    """Spreads from a million to one, correlated: the first factor needs its shift, the components come out exact."""
    rng = np.random.default_rng(4)
    turn = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    spreads = 10.0 ** np.linspace(6, -0.5, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3000, 12)) * spreads @ turn)]
    got = whitening.report(spark.createDataFrame([(k, v, 1) for k, v in rows], KIND).repartition(5)).collect()
    compared(got, rows, tolerance=1e-4)


def test_directions_without_spread_are_no_components(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 4))
    x = np.concatenate([base, base[:, :1], np.full((400, 1), 3.0), base[:, 1:2] * 1.0], axis=1)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], KIND)
    got = whitening.report(df).collect()
    assert {r.component for r in got} == {1, 2, 3, 4} and got[0].identity_error < 1e-9
    assert abs(sum(r.explained for r in got if r.vec_id == 0) - 1) < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(6)
    good = [(i, rng.normal(size=3).tolist(), 1) for i in range(50)]
    odd = [(90, None, 1), (91, [1.0, None, 2.0], 1), (92, [nan, 1.0, 1.0], 1), (93, [inf, 0.0, 0.0], None), (94, [], 1),
           (95, [1.0, 2.0], 1), (96, [1e300, 0.0, 0.0], 1)]
    df = spark.createDataFrame(good + odd, KIND)
    compared(whitening.report(df).collect(), [(k, v) for k, v, _ in good])
    repeated = spark.createDataFrame(good + [good[0], (None, [0.5, 0.25, 0.0], 2)], KIND).withColumnRenamed("label", "_x")
    got = whitening.report(repeated).collect()
    assert len(got) == 52 * 3 and sum(r.vec_id == 0 for r in got) == 6 and sum(r.vec_id is None for r in got) == 3
    assert whitening.report(df.limit(0)).columns == COLUMNS and whitening.report(df.limit(0)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], KIND)
    assert whitening.report(same).count() == 0


@pytest.mark.parametrize("size", [10, 10**9, 1 << 61])
def test_deviation_is_exact(size):
    x = np.array([[size, 3], [size + 7, -size]], np.int64)
    totals = [sum(map(int, column)) for column in x.T]
    want = [sum((2 * int(a) - int(s)) ** 2 for a, s in zip(row, totals)) for row in x]
    fit = whitening.Fit(2, tuple(map(int, totals)), np.zeros((0, 2)), np.zeros(0), 0.0)
    assert fit.deviations(x) == [v if v < 1 << 63 else None for v in want]
