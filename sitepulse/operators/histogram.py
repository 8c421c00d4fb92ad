"""Histograms with a density (PDF) and a running density (CDF)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitepulse.functions import rum


def pdf_cdf(volumes: DataFrame, by: Sequence[str], bin: str = "bin", volume: str = "volume") -> DataFrame:
    """Add ``pdf`` and ``cdf`` to one row per ``(by, bin)``. NULL bins come first.

    The windows run over aggregated bins, not over input rows, so a partition of them is as long
    as one report.
    """
    whole = Window.partitionBy(*by)
    upto = whole.orderBy(F.col(bin).asc_nulls_first()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    pdf = F.try_divide(F.col(volume).cast("double"), F.sum(volume).over(whole).cast("double"))
    return volumes.withColumn("pdf", pdf).withColumn("cdf", F.sum("pdf").over(upto))


def histogram(
    rows: DataFrame,
    bin: Column,
    by: Sequence[str] = ("client",),
    keep_null: bool = True,
    minimum: float | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """Count (or sum ``weight`` of) rows per bin and group, with PDF and CDF.

    Conditions on the bin are applied before grouping, where they cost nothing.
    """
    binned = rows.withColumn("bin", bin)
    if not keep_null:
        binned = binned.where(F.col("bin").isNotNull())
    if minimum is not None:
        binned = binned.where(F.col("bin") >= F.lit(minimum))
    volume = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return pdf_cdf(binned.groupBy(*by, "bin").agg(volume.alias("volume")), by)


def ordered(hist: DataFrame, by: Sequence[str] = ("client",)) -> DataFrame:
    """Report order: by bin (NULL first), then group."""
    return hist.orderBy(F.col("bin").asc_nulls_first(), *by)


def bin_volumes(rows: DataFrame, bins: Column, by: Sequence[str]) -> DataFrame:
    """Total density per group and given bin ``(start, end)`` of pre-binned rows.

    Rows with a NULL or empty array drop out.
    """
    return (
        rows.select(*by, F.explode(bins).alias("b"))
        .groupBy(*by, F.col("b.start").alias("start"), F.col("b.end").alias("end"))
        .agg(F.sum("b.density").alias("density"))
    )


def spread_volumes(
    volumes: DataFrame, by: Sequence[str], width: Column, clamp: Column, dtype: str = "bigint"
) -> DataFrame:
    """Spread summed bins over equal steps: one row per ``(by, bin)``.

    Spreading is linear in the density, so it runs after the bins were summed: on as many rows
    as there are distinct bins, not on one array per site.
    """
    steps = rum.spread(F.col("start"), F.col("end"), F.col("density"), width, clamp, dtype)
    return (
        volumes.select(*by, F.explode(steps).alias("s"))
        .groupBy(*by, F.col("s.start").alias("bin"))
        .agg(F.sum("s.density").alias("volume"))
    )


def raw_volumes(volumes: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bins as they are, keyed by their start."""
    return volumes.groupBy(*by, F.col("start").alias("bin")).agg(F.sum("density").alias("volume"))
