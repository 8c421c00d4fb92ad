import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sitepulse.operators import distribution


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    values = rng.lognormal(6, 2, 6000).astype(int)
    values[:2000] = 37  # one value holds a third of all rows
    frame = pd.DataFrame({"s": np.where(rng.random(6000) < 0.3, "a", "b"), "v": values})
    counts = distribution.value_counts(spark.createDataFrame(frame), F.col("v"), ["s"])
    return frame, counts


def test_quantiles(data):
    frame, counts = data
    found = distribution.exact_quantiles(counts, {"a": 0.25, "b": 0.5, "c": 0.97, "d": 1.0}, ["s"]).toPandas().set_index("s")
    expected = frame.groupby("s").v.quantile([0.25, 0.5, 0.97, 1.0]).unstack()
    assert np.allclose(found.sort_index().values, expected.sort_index().values)


def test_summary(data):
    frame, counts = data
    for row in distribution.quartile_summary(counts, ["s"]).collect():
        v = frame[frame.s == row.s].v
        assert tuple(row)[1:] == tuple(int(x) for x in (*v.quantile([0.25, 0.5, 0.75]), v.mean()))


def test_equal_width_histogram(data):
    frame, counts = data
    found = distribution.equal_width_histogram(counts, ["s"], trim=0.97).toPandas()
    for s, v in frame.groupby("s").v:
        top = int(v.quantile(0.97))
        expected, _ = np.histogram(v, bins=50, range=(0, top))
        got = np.zeros(50, dtype=int)
        rows = found[found.s == s]
        got[rows.bin.astype(int)] = rows.n
        # Edges of the array library are binary floats; sums and almost all bins agree.
        assert got.sum() == expected.sum() and np.abs(got - expected).sum() <= 4


def test_zero_cut_gives_nothing(spark):
    counts = distribution.value_counts(spark.createDataFrame([("a", 0)] * 5, "s string, v bigint"), F.col("v"), ["s"])
    assert distribution.equal_width_histogram(counts, ["s"]).count() == 0


def test_cdf_points(data):
    frame, counts = data
    cdf = distribution.empirical_cdf(counts, ["s"])
    points = distribution.cdf_points(cdf, ["s"], chunk=64).toPandas()
    for s, v in frame.groupby("s").v:
        got = points[points.s == s].sort_values("cdf")
        assert np.allclose(got.cdf, np.linspace(0, 1, len(v))) and (got.value.values == np.sort(v)).all()
    trimmed = distribution.empirical_cdf(counts, ["s"], trim=0.97).groupBy("s").agg(F.max("value").alias("m")).collect()
    for row in trimmed:
        assert row.m <= int(frame[frame.s == row.s].v.quantile(0.97))
