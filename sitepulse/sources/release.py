"""Crawl date and client from the name of a release or archive."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

RELEASE = r"([A-Za-z]+)-([A-Z][a-z]{2}_\d{1,2}_\d{4})"
ARCHIVE_DATE = r"([A-Z][a-z]{2}_\d{1,2}_\d{4})"


def release_date(release: Column) -> Column:
    """Date of ``chrome-Mar_01_2020``."""
    return F.to_date(F.split(release, "-")[1], "MMM_d_yyyy")


def release_client(release: Column, strict: bool = True) -> Column:
    """Client of a release: ``chrome`` is desktop, ``android`` is mobile.

    Other names are kept, or with ``strict=False`` taken for mobile.
    """
    name = F.split(release, "-")[0]
    other = name if strict else F.lit("mobile")
    return F.when(name == "chrome", "desktop").when(name == "android", "mobile").otherwise(other)


def release_of_path(path: Column) -> Column:
    """The release folder in a file path; NULL when there is none."""
    found = F.regexp_extract(path, RELEASE, 0)
    return F.when(found != "", found)


def archive_date(archive: Column) -> Column:
    """Date of ``mobile_Dec_15_2018`` or ``Jan_1_2019``."""
    return F.to_date(F.regexp_extract(archive, ARCHIVE_DATE, 1), "MMM_d_yyyy")


def archive_client(archive: Column) -> Column:
    return F.when(archive.contains("mobile"), "mobile").otherwise("desktop")


def target_name(dataset: str, date: Column, client: Column) -> Column:
    """``dataset.YYYY_MM_DD_client``."""
    return F.concat(F.lit(f"{dataset}."), F.date_format(date, "yyyy_MM_dd"), F.lit("_"), client)
