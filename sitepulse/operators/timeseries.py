"""Aggregates per crawl date and client."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import nextafter

from pyspark.sql import Column, DataFrame, functions as F

from sitepulse.functions import scalar

# Quantile positions p10, p25, p50, p75, p90 out of 1001 and out of 1000.
QUANTILE_NAMES = ("p10", "p25", "p50", "p75", "p90")
OFFSETS = {1001: (101, 251, 501, 751, 901), 1000: (100, 250, 500, 750, 900)}

# Rank error 1/ACCURACY: ten times finer than the 1/1000 step between two quantile positions.
ACCURACY = 10_000


def quantiles(value: Column, buckets: int = 1001, accuracy: int = ACCURACY) -> Column:
    """All five quantiles of one value from a single mergeable sketch.

    Position k of n * k / buckets rows is meant exactly, so a fraction is never rounded upwards.
    """
    fractions = F.array(*[F.lit(nextafter(k / buckets, 0)) for k in OFFSETS[buckets]])
    return F.percentile_approx(value, fractions, F.lit(accuracy))


def quantile_columns(
    sketch: Column, scale: float = 1, places: int | None = 2
) -> list[Column]:
    """``p10`` .. ``p90`` from a quantile array."""

    def scaled(quantile: Column) -> Column:
        value = quantile.cast("double") / F.lit(float(scale))
        return value if places is None else F.round(value, places)

    values = F.transform(sketch, scaled)
    return [F.get(values, F.lit(i)).alias(name) for i, name in enumerate(QUANTILE_NAMES)]


def count_where(condition: Column) -> Column:
    return F.coalesce(F.sum(scalar.one_if(condition)), F.lit(0)).cast("bigint")


def dated(aggregated: DataFrame, columns: Sequence[Column | str], keys: Sequence[str] = ()) -> DataFrame:
    """Turn a ``date`` column into the two report columns, followed by ``client``.

    Grouping happens on the plain date beforehand, never on the formatted text.
    """
    return aggregated.select(
        *keys,
        scalar.report_date(F.col("date")).alias("date"),
        scalar.epoch_ms(F.col("date")).alias("timestamp"),
        "client",
        *columns,
    )


def newest_first(series: DataFrame, *extra: Column) -> DataFrame:
    return series.orderBy(F.col("date").desc(), "client", *extra)


def matches(array: Column, predicate) -> Column:
    """Elements that satisfy a predicate; an empty array for NULL."""
    return F.coalesce(F.filter(array, predicate), F.array())


def left_unnest_rows(matched: Column) -> Column:
    """Rows a left unnest gives: one per match, one for none. No row is multiplied to count them."""
    return F.greatest(F.size(matched), F.lit(1))


def distinct_shares(
    rows: DataFrame,
    by: Sequence[str],
    key: str,
    flags: Mapping[str, Column],
    present: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Count distinct ``key`` per group, in total (``keys``) and among rows where a flag holds.

    One pre-aggregate per (group, key) replaces the row expansion of several DISTINCT counts:
    duplicates of a hot key combine before the shuffle. ``present`` flags tell whether any row of
    the group satisfies a condition, whatever its key.
    """
    present = present or {}
    ones = {name: F.max(scalar.one_if(flag)).alias(name) for name, flag in {**flags, **present}.items()}
    per_key = rows.groupBy(*by, key).agg(F.lit(1).alias("_one"), *ones.values())
    counted = [F.sum(F.when(F.col(key).isNotNull(), F.col(name))).alias(name) for name in flags]
    return per_key.groupBy(*by).agg(
        F.count(F.col(key)).alias("keys"), *counted, *[F.max(name).alias(name) for name in present]
    )
