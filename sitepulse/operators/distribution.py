"""Exact distributions: running sums, quantiles, CDFs and summaries.

Everything starts from counts per distinct value, so ties cost one row. Running sums are taken inside ranges of
values that Spark deals by size, and the totals of the ranges before are added back, so no task ever holds one whole
series. ``by`` names the columns that label a series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import nextafter

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitepulse.session import stage


def value_counts(rows: DataFrame, value: Column, by: Sequence[str]) -> DataFrame:
    """Rows per distinct value: columns ``by, value, n``. NULL values drop out."""
    return (
        rows.select(*by, value.alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy(*by, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def running_total(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add ``upto`` (rows with a value up to this one) and ``total`` to value counts.

    The counts are dealt to ranges of (series, value) and staged, so they are computed once however often the result is
    used; a series of any share of all rows is spread over the tasks. What a range adds to each series is one
    row, and these rows are summed in order.
    """
    ranges = stage(counts.repartitionByRange(*by, "value").withColumn("_range", F.spark_partition_id()), "value-ranges")
    series = Window.partitionBy(*by)
    before = series.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranges.groupBy(*by, "_range")
        .agg(F.sum("n").alias("_n"))
        .select(
            *by, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(series).alias("total")
        )
    )
    inside = Window.partitionBy(*by, "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranges.withColumn("_inside", F.sum("n").over(inside))
        .join(totals, [*by, "_range"])
        .select(*by, "value", "n", (F.col("_before") + F.col("_inside")).alias("upto"), "total")
    )


def exact_quantiles(
    counts: DataFrame, probabilities: Mapping[str, float], by: Sequence[str], discrete: bool = False
) -> DataFrame:
    """Exact quantiles of value counts, one row per group.

    Linear interpolation between neighbours, or with ``discrete`` the smallest value whose share
    of rows up to it reaches the probability.
    """
    return _quantiles(running_total(counts, by), probabilities, by, discrete)


def _quantiles(
    ranked: DataFrame, probabilities: Mapping[str, float], by: Sequence[str], discrete: bool = False, *more: Column
) -> DataFrame:
    """The quantiles of running totals, and ``more`` aggregates of the same rows."""
    ranked = ranked.withColumn("_from", F.col("upto") - F.col("n"))

    def at(position: Column) -> Column:
        inside = (F.col("_from") <= position) & (position < F.col("upto"))
        return F.max(F.when(inside, F.col("value")))

    parts, results = [F.max("total").alias("_total")], []
    for name, p in probabilities.items():
        if discrete:
            position = F.greatest(F.ceil(F.col("total") * F.lit(nextafter(p, 0))), F.lit(1)) - 1
            parts.append(at(position).alias(f"_{name}"))
            results.append(F.col(f"_{name}").alias(name))
        else:
            position = (F.col("total") - 1) * F.lit(float(p))
            parts += [
                at(F.floor(position)).cast("double").alias(f"_{name}_lo"),
                at(F.ceil(position)).cast("double").alias(f"_{name}_hi"),
            ]
            h = (F.col("_total") - 1) * F.lit(float(p))
            lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
            results.append((lo + (hi - lo) * (h - F.floor(h))).alias(name))
    names = [f"_more{i}" for i in range(len(more))]
    found = ranked.groupBy(*by).agg(*parts, *(column.alias(name) for name, column in zip(names, more)))
    return found.select(*by, *results, *names)


def quartile_summary(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Quartiles and mean of each series, cut to whole numbers."""
    mean = F.sum(F.col("value") * F.col("n")) / F.sum("n")
    found = _quantiles(running_total(counts, by), {"q1": 0.25, "q2": 0.5, "q3": 0.75}, by, False, mean)
    found = found.withColumnRenamed("_more0", "mean")
    return found.select(*by, *[F.col(c).cast("bigint").alias(c) for c in ("q1", "q2", "q3", "mean")])


def _with_cut(ranked: DataFrame, trim: float, by: Sequence[str]) -> DataFrame:
    """Add ``cut``, the whole part of the trim quantile of each series.

    One row per series, so the join is broadcast when Spark finds it small.
    """
    cuts = _quantiles(ranked, {"cut": trim}, by).withColumn("cut", F.col("cut").cast("bigint"))
    return ranked.join(cuts, list(by))


def equal_width_histogram(
    counts: DataFrame, by: Sequence[str], bins: int = 50, trim: float = 1.0
) -> DataFrame:
    """Counts in equal bins over ``[0, trim quantile]``; values outside drop out.

    The last bin is closed. A series whose cut is 0 gives no rows.
    """
    position = F.expr(f"(value * {bins}) div cut").cast("int")
    inside = (F.col("cut") > 0) & F.col("value").between(F.lit(0), F.col("cut"))
    return (
        _with_cut(running_total(counts, by), trim, by)
        .where(inside)
        .groupBy(*by, "cut", F.least(position, F.lit(bins - 1)).alias("bin"))
        .agg(F.sum("n").alias("n"))
        .select(
            *by,
            "bin",
            (F.col("bin") * F.col("cut") / F.lit(bins)).alias("low"),
            ((F.col("bin") + 1) * F.col("cut") / F.lit(bins)).alias("high"),
            "n",
        )
    )


def empirical_cdf(counts: DataFrame, by: Sequence[str], trim: float | None = None) -> DataFrame:
    """Empirical CDF with evenly spaced heights 0 .. 1 over the sorted rows of each series.

    Equal values are consecutive rows, so one row per value with its first and last height says
    it all. ``trim`` cuts the value axis, after the heights are set.
    """
    ranked = running_total(counts, by)
    last = F.greatest(F.col("total") - 1, F.lit(1))
    if trim is not None:
        ranked = _with_cut(ranked, trim, by).where(F.col("value") <= F.col("cut"))
    return ranked.select(
        *by,
        "value",
        "n",
        ((F.col("upto") - F.col("n")) / last).alias("cdf_first"),
        ((F.col("upto") - 1) / last).alias("cdf_last"),
    )


def cdf_points(cdf: DataFrame, by: Sequence[str], chunk: int = 65_536) -> DataFrame:
    """One row per input row: ``by, value, cdf``.

    A value repeated very often is cut into chunks that spread over tasks before they expand.
    """
    step = F.when(F.col("n") > 1, (F.col("cdf_last") - F.col("cdf_first")) / (F.col("n") - 1)).otherwise(0.0)
    chunks = cdf.select(
        *by, "value", "n", "cdf_first", step.alias("_step"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(chunk).cast("bigint"))).alias("_start"),
    ).repartition(*by, "value", "_start")
    ends = F.least(F.col("_start") + F.lit(chunk - 1), F.col("n") - 1)
    return chunks.select(
        *by, "value", "cdf_first", "_step", F.explode(F.sequence("_start", ends)).alias("_i")
    ).select(*by, "value", (F.col("cdf_first") + F.col("_i") * F.col("_step")).alias("cdf"))
