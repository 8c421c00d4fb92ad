"""Exact top-k search by exhaustive term-at-a-time accumulation over sparse integer vectors.

Candidates are dealt into chunks; a task turns a chunk into postings, one list per term. Every query row visits every
chunk: for each of its terms the weighted postings are added to a dense array of scores, one per candidate of the
chunk. A partition selection leaves the best k of the chunk, and the best of all chunks are merged per query.
Queries stream past the postings, so a task holds one chunk and one batch of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitepulse.llm.text import arrow_schema

#: Candidates that a task holds as postings, about.
CHUNK_ROWS = 1 << 18


def finite(vector: str) -> Column:
    """The vector is not null and all its components are finite numbers."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(good(x.cast("double")), F.lit(False))), F.lit(False))


def sparse(rows: DataFrame, key: str, vector: str, scale: int = 1024) -> DataFrame:
    """(id, terms, weights) of dense rows: the non-zero integers floor(scale x) and their places.

    Rows with a null key or a vector that is not ``finite`` are left out; a vector of zeros has no terms.
    """
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    places = F.filter(F.sequence(F.lit(0), F.size("_w") - 1), lambda i: F.get("_w", i) != 0)
    return (
        rows.filter(F.col(key).isNotNull() & finite(vector))
        .select(F.col(key).cast("bigint").alias("id"), whole.alias("_w"))
        .withColumn("terms", F.when(F.size("_w") > 0, places).otherwise(F.array().cast("array<int>")))
        .select("id", "terms", F.filter("_w", lambda w: w != 0).alias("weights"))
    )


class Postings:
    """The rows of a chunk by term."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        rows = np.repeat(rank, lengths)
        by_term = np.lexsort((rows, terms))
        found, first = np.unique(terms[by_term], return_index=True)
        rows, weights = rows[by_term], weights[by_term]
        self.ids = ids[order]
        ends = np.append(first[1:], len(rows))
        # A list that holds every row is added as a whole.
        whole = len(ids)
        self.lists = {
            int(t): (slice(None) if b - a == whole else rows[a:b], weights[a:b]) for t, a, b in zip(found, first, ends)
        }

    def best(self, own: int, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than ``own``; equal scores go to smaller ids."""
        scores = np.zeros(len(self.ids), np.int64)
        for term, weight in zip(terms.tolist(), weights.tolist()):
            if term in self.lists:
                rows, values = self.lists[term]
                scores[rows] += weight * values
        lo, hi = np.searchsorted(self.ids, [own, own + 1])
        ids = self.ids
        if hi > lo:
            ids, scores = np.delete(ids, slice(lo, hi)), np.delete(scores, slice(lo, hi))
        at = np.arange(len(ids))
        if len(ids) > k:
            at = np.flatnonzero(scores >= np.partition(scores, len(ids) - k)[len(ids) - k])
        at = at[np.argsort(-scores[at], kind="stable")][:k]
        return ids[at], scores[at]


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray(column.value_lengths()).astype(np.int64), np.asarray(column.flatten())


def _searched(batches: Iterator[pa.RecordBatch], k: int, schema: str) -> Iterator[pa.RecordBatch]:
    """Rows in the order (chunk, candidates, queries)."""
    target = arrow_schema(schema)
    held: list[tuple[np.ndarray, ...]] = []
    postings, current = None, None

    def postings_of_held() -> Postings | None:
        return Postings(*(np.concatenate(x) for x in zip(*held))) if held else None

    for batch in batches:
        chunk, kind, ids = (np.asarray(batch.column(i)) for i in range(3))
        lengths, terms = _lists(batch.column(3))
        _, weights = _lists(batch.column(4))
        ends = np.cumsum(lengths)
        key = chunk * 2 + kind
        cuts = np.flatnonzero(np.diff(key)) + 1
        out: list[tuple] = []
        for a, b in zip([0, *cuts], [*cuts, len(key)]):
            if chunk[a] != current:
                current, held, postings = chunk[a], [], None
            inside = slice(ends[a] - lengths[a], ends[b - 1])
            if kind[a] == 0:
                held.append((ids[a:b], lengths[a:b], terms[inside], weights[inside]))
                continue
            if postings is None:
                postings, held = postings_of_held(), []
            if postings is None:
                continue
            for i in range(a, b):
                at = slice(ends[i] - lengths[i], ends[i])
                found, scores = postings.best(int(ids[i]), terms[at], weights[at], k)
                out.append((np.full(len(found), ids[i]), found, scores))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, target)], schema=target)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k candidates with the highest inner products.

    Both sides are (id, terms array<int>, weights array<bigint>), terms of a row being distinct. A query's own id is no
    candidate; equal scores go to smaller ids; with fewer than k candidates all are returned. A candidate row that is
    repeated counts each time, a query row once. Scores are 64-bit sums.
    """
    spark = candidates.sparkSession
    rows = candidates.count()
    chunks = max(-(-rows // chunk_rows), int(spark.conf.get("spark.sql.shuffle.partitions")))
    columns = ["_chunk", "_kind", "id", "terms", "weights"]
    given = candidates.select(
        F.pmod(F.xxhash64("id", "weights"), F.lit(chunks)).cast("bigint").alias("_chunk"), F.lit(0).alias("_kind"), "id", "terms", "weights"
    )
    asked = queries.distinct().select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))).alias("_chunk"),
        F.lit(1).alias("_kind"), "id", "terms", "weights",
    )
    schema = "query_id bigint, vec_id bigint, score bigint"
    found = (
        given.unionAll(asked)
        .select(*columns)
        .repartition(chunks, "_chunk")
        .sortWithinPartitions("_chunk", "_kind")
        .mapInArrow(lambda batches: _searched(batches, k, schema), schema)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


#: The check, for vectors of one length.
SQL = """
WITH valid AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(CAST(q.w AS DOUBLE[]), CAST(c.w AS DOUBLE[])) AS BIGINT) AS score
  FROM valid q JOIN valid c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
