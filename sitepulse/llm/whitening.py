"""Whitening of embeddings by shifted CholeskyQR.

The centred rows are a tall matrix that no task holds. Its Gram matrix is a sum over rows, so it is computed in tasks
and added by Spark. The triangular factor of the Gram matrix orthogonalises the rows (a triangular solve per row), the Gram
matrix of the solved rows gives the next factor, and so on until the rows are orthonormal; the product of all factors is
the R of a QR decomposition. The first factor is of a shifted Gram matrix, so that a badly conditioned one has a factor
too. The singular values and right vectors of R, a small square, are those of the centred rows: they give the
components without ever squaring the condition of the data.

What the driver holds is square in the width of a vector and does not grow with the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.search import finite

#: x = floor(SCALE * c) + OFFSET
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Entries up to this size, times the scale, are longs; larger ones count as not finite.
LARGEST = float(1 << 62) / SCALE
#: The rows are orthonormal when their Gram matrix is this close to the identity.
CLOSE = 1e-12
#: Passes at most. Three do for any condition; what is left then has a direction without any spread.
PASSES = 6

Rows = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Fit:
    """The whitening of one table: ``axes`` has a component a row, ``variances`` fall."""

    count: int
    sums: tuple[int, ...]  # of the whole numbers, per dimension
    axes: np.ndarray
    variances: np.ndarray
    trace: float

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: as longs, or as Python's whole numbers where longs might not hold it."""
        largest = max(map(abs, self.sums), default=0) + self.count * int(np.abs(x).max(initial=0))
        return self.count * x.astype(object if largest >> 63 else np.int64) - np.array(self.sums, object if largest >> 63 else np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.apart(x) / self.count).astype(np.float64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes.T / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of (n x - S)^2 of every row; None beyond a long."""
        apart = self.apart(x)
        if not apart.size or int(np.abs(apart).max()) ** 2 * apart.shape[1] < 1 << 63:
            return (apart * apart).sum(axis=1).tolist()
        exact = [sum(v * v for v in row) for row in apart.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``_key`` and ``_x``, the whole numbers of the entries, of every row that takes part.

    A null or empty vector and one with null, non-finite or enormous entries take no part. Vectors take part
    if they have the most frequent width, the largest of several.
    """
    small = F.forall(vector, lambda c: F.abs(c.cast("double")) <= LARGEST)
    given = rows.filter(finite(vector) & F.coalesce(small, F.lit(False)) & (F.size(vector) > 0))
    widths = given.groupBy(F.size(vector).alias("width")).count().orderBy(F.desc("count"), F.desc("width"))
    first = widths.first()
    width = first.width if first else 0
    x = F.transform(vector, lambda c: (F.floor(c.cast("double") * SCALE) + OFFSET).cast("bigint"))
    return given.filter(F.size(vector) == width).select(F.col(key).alias("_key"), x.alias("_x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    vectors = batch.column("_x")
    return np.asarray(vectors.flatten()).reshape(batch.num_rows, -1)


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Rows and the exact sum of each dimension, added in halves of 32 bits."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, high, low = 0, 0, 0
        for batch in filter(len, batches):
            x = _matrix(batch)
            count, high, low = count + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if count:
            columns = [np.arange(len(high)), high, low, np.full(len(high), count)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["at", "high", "low", "rows"])

    parts = rows.select("_x").mapInArrow(partial, "at bigint, high bigint, low bigint, rows bigint")
    added = parts.groupBy("at").agg(*(F.sum(c).alias(c) for c in ("high", "low", "rows"))).orderBy("at").collect()
    return (added[0].rows, [(r.high << 32) + r.low for r in added]) if added else (0, [])


def _gram(rows: DataFrame, turned: Rows, width: int) -> np.ndarray:
    """The sum over all rows of the outer product of ``turned(x)`` with itself."""
    upper = np.triu_indices(width)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in filter(len, batches):
            q = turned(_matrix(batch))
            total += q.T @ q
        columns = [pa.array(np.arange(len(upper[0]))), pa.array(total[upper])]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "total"])

    parts = rows.select("_x").mapInArrow(partial, "at bigint, total double")
    found = parts.groupBy("at").agg(F.sum("total").alias("total")).collect()
    out = np.zeros((width, width))
    at = np.array([r.at for r in found], np.int64)
    out[upper[0][at], upper[1][at]] = [r.total for r in found]
    return out + np.triu(out, 1).T


def _factor(gram: np.ndarray, count: int, shifted: bool) -> np.ndarray:
    """The upper triangular factor of a Gram matrix, ``shifted`` or if it has none without."""
    width = len(gram)
    least = 11 * (count * width + width * (width + 1)) * np.finfo(float).eps / 2 * max(np.linalg.norm(gram, 2), 1e-300)
    shift = least if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(width)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, least)


def _solved(factors: list[np.ndarray], centred: Rows) -> Rows:
    """Rows times the inverses of the factors, one triangular solve after the other."""

    def turned(x: np.ndarray) -> np.ndarray:
        q = centred(x).T
        for r in factors:
            q = _forward(r, q)
        return q.T

    return turned


def _forward(r: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solve r.T q = b, with r upper triangular, by forward substitution over all columns of b at once."""
    q = np.empty_like(b)
    for i in range(len(r)):
        q[i] = (b[i] - r[:i, i] @ q[:i]) / r[i, i]
    return q


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The first components of ``usable`` rows, by falling variance; None if there are no rows.

    Directions without any spread are no components, so there may be fewer than asked for. Equal variances leave the
    choice of axes open. Each pass reads the rows once.
    """
    count, sums = _sums(rows)
    if not count:
        return None
    width = len(sums)
    centred = Fit(count, tuple(sums), np.zeros((0, width)), np.zeros(0), 0.0).centred
    factors: list[np.ndarray] = []
    composed, trace = np.eye(width), 0.0
    for done in range(PASSES + 1):
        gram = _gram(rows, _solved(factors, centred), width)
        if not factors:
            trace = float(np.trace(gram)) / count
            if not trace:
                return Fit(count, tuple(sums), np.zeros((0, width)), np.zeros(0), 0.0)
        if done == PASSES or np.abs(gram - np.eye(width)).max() <= CLOSE:
            # What is left of the Gram matrix is the identity, or nothing in directions without spread.
            values, vectors = np.linalg.eigh(gram)
            composed = (vectors * np.sqrt(np.maximum(values, 0))) @ vectors.T @ composed
            break
        factors.append(_factor(gram, count, not factors))
        composed = factors[-1] @ composed
    _, spread, axes = np.linalg.svd(composed)
    there = spread > spread[0] * width * 1e-12
    kept = np.flatnonzero(there)[:components]
    return Fit(count, tuple(sums), axes[kept], spread[kept] ** 2 / count, trace)


def identity_error(rows: DataFrame, found: Fit) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, by a pass over all rows."""
    size = len(found.variances)

    def with_one(x: np.ndarray) -> np.ndarray:
        white = found.whitened(x)
        return np.concatenate([white, np.ones((len(x), 1))], axis=1)

    gram = _gram(rows, with_one, size + 1)
    mean = gram[:size, size] / found.count
    return float(np.abs(gram[:size, :size] / found.count - np.outer(mean, mean) - np.eye(size)).max(initial=0.0))


def report(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per usable row and component: the key, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``.

    Rows that repeat a key, and a null key, are rows like others. ``deviation`` is null where it exceeds a long. An empty
    table, and one whose vectors are all equal, give no rows.
    """
    given = usable(rows, key, vector)
    found = fit(given, components)
    kind = given.schema["_key"].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if found is None or not len(found.variances):
        return rows.sparkSession.createDataFrame([], schema)
    error, size = identity_error(given, found), len(found.variances)
    explained = found.variances / found.trace

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            x = _matrix(batch)
            n = len(x)
            each = np.repeat(np.arange(n), size)
            columns = [
                batch.column("_key").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), n)),
                pa.array(np.full(n * size, found.count)),
                pa.array(found.deviations(x), pa.int64()).take(pa.array(each)),
                pa.array(found.whitened(x).ravel()),
                pa.array(np.tile(explained, n)),
                pa.array(np.full(n * size, error)),
            ]
            names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return given.mapInArrow(of_batches, schema)
