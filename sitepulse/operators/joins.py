"""Joins of the reports: array unnesting, requests to pages, and site restrictions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sitepulse.functions import rum, scalar

# The five columns that tie a request to its page. NULL in any of them matches nothing.
PAGE_KEYS = ("date", "client", "is_root_page", "rank", "page")


def unnest(rows: DataFrame, array: Column, name: str) -> DataFrame:
    """One row per element; rows with an empty or NULL array drop out."""
    return rows.withColumn(name, F.explode(array))


def left_unnest(
    rows: DataFrame, array: Column, name: str, predicate: Callable[[Column], Column] | None = None
) -> DataFrame:
    """One row per matching element, and one row with a NULL element where none matches."""
    elements = F.filter(array, predicate) if predicate is not None else array
    return rows.withColumn(name, F.explode_outer(elements))


def sums_on_pages(
    requests: DataFrame,
    pages: DataFrame,
    measures: Mapping[str, Column],
    by: Sequence[str] = (),
    subsets: Mapping[str, Column] | None = None,
    subset: str = "lens",
) -> DataFrame:
    """Sums over the join of requests to pages, per ``PAGE_KEYS``, ``by`` and subset of pages.

    Both sides are summed per key first and the join multiplies the request sums by the number
    of matching page rows, which is what the row-by-row join would add up to. A page holding a
    large share of all requests shrinks to a few rows before it is shuffled. ``subsets`` are named
    predicates on pages; each becomes one counter beside the key, so pages shuffle once.
    """
    subsets = subsets or {"": F.lit(True)}

    def keyed(df: DataFrame) -> DataFrame:
        present = F.lit(True)
        for key in PAGE_KEYS:
            present = present & F.col(key).isNotNull()
        return df.where(present)

    requested = keyed(requests).groupBy(*PAGE_KEYS, *by).agg(
        *[F.sum(value).alias(name) for name, value in measures.items()]
    )
    in_any = F.lit(False)
    for predicate in subsets.values():
        in_any = in_any | predicate
    counters = {name: f"_pages_{i}" for i, name in enumerate(subsets)}
    crawled = (
        keyed(pages)
        .where(in_any)
        .groupBy(*PAGE_KEYS)
        .agg(*[F.sum(scalar.one_if(subsets[name])).alias(column) for name, column in counters.items()])
    )
    joined = requested.join(crawled, list(PAGE_KEYS), "inner")
    if len(counters) == 1:
        ((name, column),) = counters.items()
        matched = joined.withColumn(subset, F.lit(name)).withColumnRenamed(column, "_page_rows")
    else:
        each = [
            F.when(F.col(column) > 0, F.struct(F.lit(name).alias("name"), F.col(column).alias("rows")))
            for name, column in counters.items()
        ]
        matched = (
            joined.withColumn("_s", F.explode(F.array_compact(F.array(*each))))
            .withColumn(subset, F.col("_s.name"))
            .withColumn("_page_rows", F.col("_s.rows"))
        )
    return matched.select(
        *PAGE_KEYS,
        *by,
        subset,
        *[(F.col(name) * F.col("_page_rows")).alias(name) for name in measures],
    )


def restrict_rum_to_pages(rum_rows: DataFrame, pages: DataFrame, on_month: bool = False) -> DataFrame:
    """Pre-binned rows whose site and form factor occur among the pages.

    The right side only filters, so a semi join does; its keys need no DISTINCT. With ``on_month``
    the page date has to fall in the row's month as well, for several months in one pass.
    """
    sites = pages.select(
        scalar.drop_last_char(F.col("page")).alias("_origin"),
        rum.form_factor_of(F.col("client")).alias("_form_factor"),
        *([F.date_format("date", "yyyyMM").cast("int").alias("_yyyymm")] if on_month else []),
    )
    on = (F.col("origin") == F.col("_origin")) & (F.col("form_factor.name") == F.col("_form_factor"))
    if on_month:
        on = on & (F.col("yyyymm") == F.col("_yyyymm"))
    return rum_rows.join(sites, on, "left_semi")


def restrict_summary_to_pages(summary: DataFrame, pages: DataFrame) -> DataFrame:
    """Device-summary rows whose ``(origin, device, date)`` occurs among the pages."""
    sites = pages.select(
        scalar.drop_last_char(F.col("page")).alias("origin"),
        rum.device_of(F.col("client")).alias("device"),
        "date",
    )
    return summary.join(sites, ["origin", "device", "date"], "left_semi")
