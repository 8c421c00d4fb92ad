"""Connected components of a link table, by alternating star steps over DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.session import drop, scratch_path

#: Links a task holds while it replaces them by a spanning forest of their own.
FOREST_ROWS = 1 << 20


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links ``a``-``b`` and, for each, the smallest node it is connected to."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = inverse[: len(a)], inverse[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links (u, v) that a task reads by links to the root of their component."""
    held: list[np.ndarray] = []
    rows = 0

    def flush() -> pa.RecordBatch:
        links = np.concatenate(held, axis=1) if held else np.zeros((2, 0), np.int64)
        nodes, root = roots(links[0], links[1])
        apart = nodes != root
        return pa.RecordBatch.from_arrays([pa.array(nodes[apart]), pa.array(root[apart])], names=["u", "v"])

    for batch in batches:
        held.append(np.stack([np.asarray(batch.column(0)), np.asarray(batch.column(1))]))
        rows += batch.num_rows
        if rows >= FOREST_ROWS:
            yield flush()
            held, rows = [], 0
    if held:
        yield flush()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (u, v, both long).

    Only nodes with a link to another node appear; nulls and loops count as no link. Large-star and
    small-star steps alternate until the links are stars around the smallest nodes. Every step is a
    grouped minimum and a join, so no task holds the neighbours of a node; each round is written to the
    shared folder, which cuts the lineage, and the round before it is removed.
    """
    spark = links.sparkSession
    path = scratch_path(spark, "links")
    (
        links.select(F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v"))
        .filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()  # equal links of many tasks meet before each task spans what it reads
        .mapInArrow(forest, "u bigint, v bigint")
        .distinct()
        .write.parquet(path)
    )
    before = None
    while True:
        edges = spark.read.schema("u bigint, v bigint").parquet(path)
        # Stars already: every node has one smaller neighbour, and no neighbour is itself linked further down.
        deeper = edges.select("u").intersect(edges.select("v"))
        several = edges.groupBy("u").count().filter("count > 1").select("u")
        if before and deeper.unionAll(several).isEmpty():
            drop(spark, before)
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        large = _star(edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "v > u")
        large = large.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        small = _star(large, "true")
        minimum = large.groupBy("u").agg(F.min("v").alias("v"))
        written = scratch_path(spark, "links")
        small.unionAll(minimum).filter("u <> v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        ).distinct().mapInArrow(forest, "u bigint, v bigint").distinct().write.parquet(written)
        if before:
            drop(spark, before)
        before, path = path, written


def _star(edges: DataFrame, kept: str) -> DataFrame:
    """Link the neighbours of every node (those for which ``kept`` holds) to its smallest neighbour or itself."""
    least = edges.groupBy("u").agg(F.min("v").alias("_low")).select("u", F.least("u", "_low").alias("_low"))
    return edges.join(least, "u").filter(kept).select(F.col("v").alias("u"), F.col("_low").alias("v"))
