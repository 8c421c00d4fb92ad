"""The four input tables of the reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class CrawlTables:
    """Crawl pages and requests (raw or as typed facts) and the two real-user tables.

    Pages and requests are partitioned by ``date, client``, the pre-binned table by ``yyyymm``, so
    date conditions prune whole partitions.
    """

    pages: DataFrame | None = None
    requests: DataFrame | None = None
    rum: DataFrame | None = None
    rum_summary: DataFrame | None = None

    @classmethod
    def read(cls, spark: SparkSession, root: str) -> CrawlTables:
        def table(name: str) -> DataFrame:
            return spark.read.parquet(f"{root}/{name}")

        return cls(table("pages"), table("requests"), table("rum"), table("rum_summary"))


def scan(
    table: DataFrame,
    date: str | None = None,
    since: str | None = None,
    after: str | None = None,
    until: str | None = None,
    root_only: bool = False,
) -> DataFrame:
    """Rows of one date or of a date range, optionally of root pages only."""
    for bound, compare in (
        (date, lambda d, x: d == x),
        (since, lambda d, x: d >= x),
        (after, lambda d, x: d > x),
        (until, lambda d, x: d <= x),
    ):
        if bound is not None:
            table = table.where(compare(F.col("date"), F.to_date(F.lit(bound))))
    return table.where(F.col("is_root_page")) if root_only else table
