"""Lenses: the subsets of sites every report can be restricted to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sitepulse.operators import joins

BASE = "base"


@dataclass(frozen=True)
class Lens:
    """A subset of sites, by popularity rank or by technology.

    ``max_rank`` bounds the crawl reports, ``rum_rank`` the real-user reports: histograms take
    ranks up to it, time series only the bucket equal to it.
    """

    name: str
    max_rank: int | None = None
    rum_rank: int | None = None
    technology: str | None = None

    def on_pages(self) -> Column:
        """Predicate on crawl pages for the crawl reports."""
        if self.technology is not None:
            return F.coalesce(
                F.array_contains(F.col("technologies.technology"), self.technology), F.lit(False)
            )
        if self.max_rank is not None:
            return F.coalesce(F.col("rank") <= F.lit(self.max_rank), F.lit(False))
        return F.lit(True)

    def restrict_rum(self, rum_rows: DataFrame, pages: DataFrame, on_month: bool = False) -> DataFrame:
        """Restrict the pre-binned table; ``pages`` holds the crawl of the same month."""
        if self.technology is not None:
            return joins.restrict_rum_to_pages(rum_rows, pages.where(self.on_pages()), on_month)
        if self.rum_rank is not None:
            return rum_rows.where(F.col("experimental.popularity.rank") <= F.lit(self.rum_rank))
        return rum_rows

    def restrict_summary(self, summary: DataFrame, pages: DataFrame) -> DataFrame:
        """Restrict the device summary to sites crawled on the same date."""
        if self.technology is None and self.rum_rank is None:
            return summary
        chosen = self.on_pages() if self.technology is not None else F.col("rank") == F.lit(self.rum_rank)
        floor = F.col("date") >= F.to_date(F.lit("2010-11-15"))
        return joins.restrict_summary_to_pages(summary, pages.where(floor & F.col("is_root_page") & chosen))


# The lens catalogue. The crawl reports of top1m stop at rank 10,000.
LENSES: dict[str, Lens] = {
    lens.name: lens
    for lens in (
        Lens("drupal", technology="Drupal"),
        Lens("magento", technology="Magento"),
        Lens("top100k", max_rank=100_000, rum_rank=100_000),
        Lens("top10k", max_rank=10_000, rum_rank=10_000),
        Lens("top1k", max_rank=1_000, rum_rank=1_000),
        Lens("top1m", max_rank=10_000, rum_rank=1_000_000),
        Lens("wordpress", technology="WordPress"),
    )
}
ALL = "ALL"


def get(name: str) -> Lens:
    if name == BASE:
        return Lens(BASE)
    if name not in LENSES:
        raise KeyError(f"unknown lens {name!r}; known: {', '.join(LENSES)}")
    return LENSES[name]


def select(choice: str | None) -> list[Lens]:
    """No lens, one lens, or ``ALL``: the base and every lens."""
    if not choice:
        return [get(BASE)]
    if choice == ALL:
        return [get(BASE), *LENSES.values()]
    return [get(choice)]


def subsets(lenses: Sequence[Lens]) -> dict[str, Column]:
    """Page predicate of each lens by name."""
    return {lens.name: lens.on_pages() for lens in lenses}


def tag(pages: DataFrame, lenses: Sequence[Lens]) -> DataFrame:
    """Add a ``lens`` column: one row per lens a page belongs to.

    All lenses are then computed in one scan. With a single lens this is a plain filter.
    """
    if len(lenses) == 1:
        return pages.where(lenses[0].on_pages()).withColumn("lens", F.lit(lenses[0].name))
    names = F.array(*[F.when(lens.on_pages(), F.lit(lens.name)) for lens in lenses])
    return pages.withColumn("lens", F.explode(F.array_compact(names)))


def mask(lenses: Sequence[Lens]) -> Column:
    """One bit per lens a page belongs to. Few combinations occur, so counts per mask stay small."""
    bits = F.lit(0)
    for i, lens in enumerate(lenses):
        bits = bits + F.when(lens.on_pages(), F.lit(1 << i)).otherwise(F.lit(0))
    return bits


def unmask(rows: DataFrame, lenses: Sequence[Lens], column: str = "mask") -> DataFrame:
    """One row per lens in the mask, with a ``lens`` column; for rows that are aggregated already."""
    names = F.array(
        *[F.when(F.col(column).bitwiseAND(F.lit(1 << i)) != 0, F.lit(lens.name)) for i, lens in enumerate(lenses)]
    )
    return rows.withColumn("lens", F.explode(F.array_compact(names))).drop(column)
