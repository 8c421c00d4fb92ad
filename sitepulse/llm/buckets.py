"""Compare the rows that share a bucket, in numpy, with hot buckets split into pairs of blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.text import arrow_schema
from sitepulse.session import stage

#: Rows of a bucket that one task compares; larger buckets are cut into blocks of about this size.
BLOCK = 4096
#: One row in so many is counted to find the buckets to cut. A bucket missed stays whole, which costs time only.
SAMPLE = 8
#: The list of buckets to cut is broadcast up to this size and joined by shuffle beyond it.
BROADCAST_ROWS = 100_000

Pairs = Callable[[dict[str, np.ndarray], np.ndarray, np.ndarray], object]


def sampled() -> Column:
    """Whether a row's ``_id`` is among those that are counted."""
    return F.pmod(F.xxhash64("_id"), F.lit(SAMPLE)) == 0


def blocks(rows: DataFrame, block: int = BLOCK, *, sample: DataFrame | None = None) -> DataFrame:
    """Add ``_pair`` to rows of ``_bucket`` (long) and ``_id`` (long).

    Two rows of a bucket are to be compared where they meet, in the rows with equal bucket and pair. A small
    bucket is one pair; a bucket of n blocks makes n(n+1)/2, and each of its rows enters n of them. Rows that
    enter a pair of different blocks carry their block in ``_side``, and only different sides are compared
    there; a block with itself has side -1. ``sample`` are the rows of ``sampled`` ids, if they come cheaper on their own.
    """
    counted = (rows.filter(sampled()) if sample is None else sample).groupBy("_bucket").count()
    hot = stage(
        counted.filter(F.col("count") * SAMPLE > block).select(
            "_bucket", F.ceil(F.col("count") * SAMPLE / block).cast("int").alias("_parts")
        ),
        "hot-buckets",
    )
    found = hot.limit(BROADCAST_ROWS + 1).count()
    if not found:
        return rows.withColumns({"_pair": F.lit(0).cast("bigint"), "_side": F.lit(-1)})
    hot = F.broadcast(hot) if found <= BROADCAST_ROWS else hot
    own = F.pmod(F.xxhash64("_id", F.lit("block")), F.col("_parts")).cast("int")
    met = F.when(F.col("_parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_parts") - 1))
    return (
        rows.join(hot, "_bucket", "left")
        .withColumn("_own", own)
        .withColumn("_other", F.explode(met))
        .withColumns(
            {
                "_pair": F.when(F.col("_parts").isNull(), F.lit(0)).otherwise(
                    F.least("_own", "_other") * F.col("_parts").cast("bigint") + F.greatest("_own", "_other")
                ),
                "_side": F.when(F.col("_own") == F.col("_other"), F.lit(-1)).otherwise(F.coalesce("_own", F.lit(-1))),
            }
        )
        .drop("_own", "_other", "_parts")
    )


def compare(rows: DataFrame, of_pairs: Pairs, gather: Callable, schema: str, vectors: str | None = None) -> DataFrame:
    """Call ``of_pairs(columns, i, j)`` on the row pairs of each bucket and ``gather`` on what a batch found.

    ``rows`` come with ``_bucket``, ``_pair`` and ``_side``. ``columns`` are numpy arrays of a stretch of
    rows that holds whole buckets; i and j are index arrays of the pairs to compare. ``gather(columns,
    found)`` turns the list of results into the columns of ``schema``. A bucket's rows are adjacent because
    the partition is sorted, so no group is collected by key; a block bounds what a task holds.
    """
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(schema)
        rest: dict[str, np.ndarray] | None = None
        for batch in batches:
            columns = {n: _array(batch.column(n)) for n in names}
            if rest is not None:
                columns = {n: _stacked(rest[n], columns[n]) for n in names}
            key_end = _last_start(columns)
            if key_end:
                yield _found({n: x[:key_end] for n, x in columns.items()}, of_pairs, gather, target)
            rest = {n: x[key_end:] for n, x in columns.items()}
        if rest is not None and len(rest["_bucket"]):
            yield _found(rest, of_pairs, gather, target)

    dealt = rows.repartition("_bucket", "_pair").sortWithinPartitions("_bucket", "_pair")
    return dealt.mapInArrow(run, schema)


def _array(column: pa.Array) -> np.ndarray:
    """A column as an array; lists as rows of a matrix, filled up with zeros."""
    if not pa.types.is_list(column.type):
        return np.asarray(column)
    sizes = np.asarray(column.value_lengths(), dtype=np.int64)
    flat = np.asarray(column.flatten())
    out = np.zeros((len(sizes), sizes.max(initial=0)), flat.dtype)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _stacked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.ndim == 2 and a.shape[1] != b.shape[1]:
        width = max(a.shape[1], b.shape[1])
        a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    return np.concatenate([a, b])


def _last_start(columns: dict[str, np.ndarray]) -> int:
    """Where the last bucket begins, which may go on in the next batch."""
    same = (columns["_bucket"] == columns["_bucket"][-1]) & (columns["_pair"] == columns["_pair"][-1])
    return len(same) - int(np.argmin(same[::-1])) if not same.all() else 0


def _found(columns, of_pairs, gather, target) -> pa.RecordBatch:
    bucket, pair, side = columns["_bucket"], columns["_pair"], columns["_side"]
    n = len(bucket)
    new = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1])]))
    end = np.repeat(np.concatenate([new[1:], [n]]), np.diff(np.concatenate([new, [n]])))
    found = []
    at, shift = np.arange(n), 1
    while True:  # rows a shift apart in one bucket; the widest bucket bounds the shifts
        at = at[at + shift < end[at]]
        if not len(at):
            break
        i, j = at, at + shift
        if (side[at] >= 0).any():
            met = (side[i] < 0) | (side[i] != side[j])
            i, j = i[met], j[met]
        if len(i):
            found.append(of_pairs(columns, i, j))
        shift += 1
    arrays = gather(columns, [x for x in found if x is not None])
    return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(arrays, target)], schema=target)


def spanning(columns: dict[str, np.ndarray], found: list[tuple[np.ndarray, np.ndarray]]) -> tuple:
    """Links as a spanning forest: no more of them than rows, however many pairs were found."""
    from sitepulse.llm.graph import roots

    a = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.int64)
    b = np.concatenate([x[1] for x in found]) if found else np.zeros(0, np.int64)
    nodes, root = roots(columns["_id"][a], columns["_id"][b])
    return nodes[nodes != root], root[nodes != root]
