"""Incremental import: only files no earlier run has seen."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from sitepulse.session import observed
from sitepulse.sources import har

PARTITIONS = ("table", "date", "client", "batch")


def write_batch(docs: DataFrame, target: str, batch: str, options: har.HarOptions = har.CURRENT) -> dict[str, int]:
    """Write the tables of one batch of documents in place of what the same batch wrote before; returns the counters.

    Rebalanced, a (table, date, client) takes as many files as its size asks for, not one per task.
    """
    seen = Observation("har batch")
    rows = har.fan_out(har.parse(har.with_release(docs)), options=options).observe(seen, *har.counter_columns())
    (
        har.settled(rows)
        .drop("path")
        .withColumn("batch", F.lit(batch))
        .hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(target)
    )
    return dict.fromkeys(har.COUNTERS, 0) | observed(seen)


def ingest_hars(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    options: har.HarOptions = har.CURRENT,
    max_files_per_batch: int | None = None,
    archive: str | None = None,
) -> dict[str, int]:
    """Import every new HAR file below ``source/<release>/``, stop, and return the counters of the run.

    ``source`` may be a glob, such as one release's folder, so a run lists only that. Rejected documents and rows
    over a size limit go to tables of their own. Files done are moved below ``archive``, if given, by a later run.

    The checkpoint remembers the files done. Each batch has a partition level of its own, named by the checkpoint's folder and
    the batch's number, and replaces it as a whole: a batch repeated after a failure neither loses nor doubles a
    document. ``target`` is for this import alone; all folders have to be shared by the cluster.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    lines = reader.load(source).select(F.col("value").alias("doc"), F.col("_metadata.file_path").alias("path"))
    name = checkpoint.rstrip("/").rsplit("/", 1)[-1]
    counters: Counter[str] = Counter()

    def write(docs: DataFrame, number: int) -> None:
        counters.update(write_batch(docs, target, f"{name}-{number}", options))

    query = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return dict(counters)
