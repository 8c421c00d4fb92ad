"""Near-duplicate embeddings by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard transform; its hash is the axis it then
comes closest to, with the sign. Two hashes make a bucket of a table. Besides its own bucket a vector enters the
buckets that a small turn would most likely put it in (multiprobe). Vectors that meet in a bucket are compared by
their cosine in double precision, in blocks; a pair that meets several times counts where it meets first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.llm import buckets, graph
from sitepulse.llm.search import finite
from sitepulse.session import stage

COSINE = 0.93
TABLES = 8
PROBES = 3
SEED = 42

#: Pairs whose vectors are laid side by side at a time.
_PAIRS = 1 << 16


def hadamard(x: np.ndarray) -> np.ndarray:
    """The unnormalised Walsh-Hadamard transform of every row; the width is a power of two."""
    rows, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(rows, -1, 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, width)
        half *= 2
    return x


def probes(x: np.ndarray, tables: int = TABLES, count: int = PROBES, seed: int = SEED) -> np.ndarray:
    """[row, table, probe]: 64-bit names of the buckets a vector enters, its own one first."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
    rng = np.random.default_rng([seed, x.shape[1]])
    near = min(3, width)
    choices = [(a, b) for a in range(near) for b in range(near) if a + b <= 2]
    out = np.zeros((len(x), tables, min(count, len(choices))), np.int64)
    for table in range(tables):
        axes, losses = [], []
        for _ in range(2):
            turned = padded
            for _ in range(3):
                turned = hadamard(turned * rng.choice([-1.0, 1.0], width)) / np.sqrt(width)
            size = np.abs(turned)
            order = np.argsort(-size, axis=1, kind="stable")[:, :near]
            top = np.take_along_axis(size, order, axis=1)
            axes.append(2 * order + (np.take_along_axis(turned, order, axis=1) < 0))
            losses.append((top[:, :1] - top) ** 2)
        loss = np.stack([losses[0][:, a] + losses[1][:, b] for a, b in choices], axis=1)
        name = np.stack([axes[0][:, a] * 2 * width + axes[1][:, b] for a, b in choices], axis=1)
        best = np.argsort(loss, axis=1, kind="stable")[:, : out.shape[2]]
        out[:, table] = np.take_along_axis(name, best, axis=1) * tables + table
    return out


def _usable(vector: str, label: str) -> Column:
    length = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.col(label).isNotNull() & finite(vector) & F.coalesce(length > 0, F.lit(False))


def _indexed(classes: DataFrame, tables: int, count: int) -> DataFrame:
    """A row per class and bucket, with the vector and all names of its buckets."""
    columns = ["_bucket", "_id", "_weight", "_label", "_width", "_vector", "_names"]
    kinds = ["bigint", "bigint", "bigint", "bigint", "bigint", "array<double>", "array<bigint>"]
    schema = ", ".join(map(" ".join, zip(columns, kinds)))

    def run(batches):
        for batch in batches:
            ids, weights, labels = (np.asarray(batch.column(i)) for i in range(3))
            vectors = batch.column(3)
            sizes = np.asarray(vectors.value_lengths())
            for width in np.unique(sizes):
                at = np.flatnonzero(sizes == width)
                x = np.asarray(vectors.take(pa.array(at)).flatten(), dtype=np.float64).reshape(len(at), width)
                found = probes(x, tables, count)
                # Labels and widths stay apart by name here and by comparison later. Vectors of one or two
                # components have fewer buckets; what fills their names up is their own.
                own = np.repeat(~np.abs(ids[at]), tables * count).reshape(len(at), tables, count)
                entered = found.shape[2]
                own[:, :, :entered] = (found * np.int64(1_000_003) + labels[at, None, None]) * np.int64(1_009) + width
                names = own.reshape(len(at), -1)
                wide = pa.array(np.full(len(at), width, np.int64))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), int(width)).cast(pa.list_(pa.float64()))
                all_names = pa.FixedSizeListArray.from_arrays(pa.array(names.ravel()), names.shape[1])
                all_names = all_names.cast(pa.list_(pa.int64()))
                for probe in (p for p in range(names.shape[1]) if p % count < entered):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[:, probe]), pa.array(ids[at]), pa.array(weights[at]), pa.array(labels[at]), wide, lists, all_names],
                        names=columns,
                    )

    return classes.select("_id", "_weight", "_label", "_vector").mapInArrow(run, schema)


def _links(classes: DataFrame, cosine: float, tables: int, count: int) -> DataFrame:
    """(u, v, n): links that connect what is linked (n null), and the weight of u's linked classes (v null)."""

    def of_pairs(columns, i, j):
        same = columns["_id"][i] != columns["_id"][j]
        for name in ("_label", "_width"):
            same &= columns[name][i] == columns[name][j]
        i, j = i[same], j[same]
        vectors, found = columns["_vector"], []
        for a in range(0, len(i), _PAIRS):
            left, right = vectors[i[a : a + _PAIRS]], vectors[j[a : a + _PAIRS]]
            dot = np.einsum("ij,ij->i", left, right)
            norm = np.sqrt(np.einsum("ij,ij->i", left, left) * np.einsum("ij,ij->i", right, right))
            near = a + np.flatnonzero(dot >= cosine * norm)
            if len(near):
                found.append(_first_meetings(columns, i[near], j[near], tables))
        if not found:
            return None
        return tuple(np.concatenate(x) for x in zip(*found))

    def gather(columns, found):
        u, v = buckets.spanning(columns, found)
        n = len(columns["_id"])
        total = np.zeros(n, np.int64)
        for i, j in found:
            np.add.at(total, i, columns["_weight"][j])
            np.add.at(total, j, columns["_weight"][i])
        linked = np.flatnonzero(total)
        return (
            np.concatenate([u, columns["_id"][linked]]),
            pa.array([*v.tolist(), *[None] * len(linked)], pa.int64()),
            pa.array([*[None] * len(u), *total[linked].tolist()], pa.int64()),
        )

    rows = buckets.blocks(_indexed(classes, tables, count))
    return buckets.compare(rows, of_pairs, gather, "u bigint, v bigint, n bigint")


def _first_meetings(columns, i, j, tables):
    """Of the linked pairs those whose first common bucket, in the order of names, is this one."""
    keep = []
    for a in range(0, len(i), _PAIRS):
        left = columns["_names"][i[a : a + _PAIRS]].reshape(-1, tables, columns["_names"].shape[1] // tables)
        right = columns["_names"][j[a : a + _PAIRS]].reshape(left.shape)
        common = (left[:, :, :, None] == right[:, :, None, :]).any(axis=3)
        first = np.where(common, left, np.iinfo(np.int64).max).min(axis=(1, 2))
        keep.append(first == columns["_bucket"][i[a : a + _PAIRS]])
    kept = np.concatenate(keep)
    return i[kept], j[kept]


def near_duplicates(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    tables: int = TABLES,
    count: int = PROBES,
) -> DataFrame:
    """Per row: the key, ``n_links``, ``component_id`` and ``kept``.

    Two rows are linked if their labels are equal and not null and their vectors' cosine is at least ``cosine``; vectors
    of unequal length are not. A null vector, one of zeros, and one with null or non-finite components links with
    nothing, not even its copy. Copies are one class with a weight and links among themselves; a row that repeats a key is
    a vector like others. A component is named by its smallest key that is not null, and the row with that key is kept.
    """
    own = rows.select(
        F.col(key).cast("bigint").alias("_key"),
        F.col(vector).alias("_own"),
        F.col(label).cast("bigint").alias("_label"),
        _usable(vector, label).alias("_usable"),
    )
    # 64 bits for a label and vector: among 10^8 distinct ones two are the same with odds of 1 in 3,700.
    own = own.withColumn("_id", F.xxhash64("_label", "_own"))
    classes = stage(
        own.filter("_usable")
        .groupBy("_id", "_label", F.transform("_own", lambda x: x.cast("double")).alias("_vector"))
        .agg(F.count("*").alias("_weight"), F.min("_key").alias("_least")),
        "vector-classes",
    )
    links = stage(_links(classes, cosine, tables, count), "vector-links")
    linked = links.filter("v is null").groupBy(F.col("u").alias("_id")).agg(F.sum("n").alias("_linked"))
    found = graph.components(links.filter("v is not null").select("u", "v")).withColumnRenamed("node", "_id")
    known = (
        classes.select("_id", "_weight", "_least")
        .join(linked, "_id", "left")
        .join(found, "_id", "left")
        .withColumn("_component", F.coalesce("component", "_id"))
        .drop("component")
    )
    least = known.groupBy("_component").agg(F.min("_least").alias("_first"))
    known = known.join(least, "_component").select(
        "_id", (F.col("_weight") - 1 + F.coalesce("_linked", F.lit(0))).alias("_n"), "_first"
    )
    # A row that links with nothing has no class.
    joined = own.select("_key", F.when(F.col("_usable"), F.col("_id")).alias("_id")).join(known, "_id", "left")
    component = F.when(F.col("_id").isNull(), F.col("_key")).otherwise(F.col("_first"))
    return joined.select(
        F.col("_key").alias(key),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("_key") == component, F.lit(False)).alias("kept"),
    )


#: The check: all pairs of equal labels, and what is reachable over them.
SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT u, u AS w FROM links UNION SELECT reach.u, links.w FROM reach JOIN links ON reach.w = links.u
), named AS (
  SELECT u, min(w) AS component_id FROM reach GROUP BY u
), counted AS (
  SELECT u, count(*) AS n FROM links GROUP BY u
)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, coalesce(n.component_id, e.vec_id) AS component_id,
  coalesce(n.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted c ON e.vec_id = c.u LEFT JOIN named n ON e.vec_id = n.u
"""
