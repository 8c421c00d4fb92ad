"""Page weights in whole kilobytes, from the flat page tables of two schema generations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sitepulse.functions import scalar

# Reported name and column.
PARTS = {
    "TOTAL": "bytesTotal", "HTML": "bytesHtml", "JS": "bytesJS", "CSS": "bytesCSS", "IMG": "bytesImg",
    "FONT": "bytesFont", "FLASH": "bytesFlash", "JSON": "bytesJson",
}
OTHER = ("bytesOther", "bytesVideo", "bytesAudio")


def kilobytes(pages: DataFrame, with_media: bool = True) -> DataFrame:
    """``RANK`` and one column per part. Newer tables count video and audio, as part of OTHER."""
    other = None
    for column in OTHER if with_media else OTHER[:1]:
        size = scalar.kilobytes(F.col(column))
        other = size if other is None else other + size
    return pages.select(
        F.col("rank").alias("RANK"),
        *[scalar.kilobytes(F.col(column)).alias(name) for name, column in PARTS.items()],
        other.alias("OTHER"),
    )


def long_form(weights: DataFrame, parts: Sequence[str], max_rank: int | None = None) -> DataFrame:
    """One row per ranked page and part: ``metric, value``; optionally only ranks below a bound."""
    weights = weights.where(F.col("RANK").isNotNull())
    if max_rank is not None:
        weights = weights.where(F.col("RANK") < F.lit(max_rank))
    return weights.select(
        F.explode(F.array(*[F.struct(F.lit(p).alias("metric"), F.col(p).alias("value")) for p in parts])).alias("m")
    ).select("m.metric", "m.value")


def compare(labelled: dict[str, DataFrame]) -> DataFrame:
    """Put several series side by side under a ``series`` label."""
    result = None
    for label, rows in labelled.items():
        rows = rows.withColumn("series", F.lit(label))
        result = rows if result is None else result.unionByName(rows)
    return result
