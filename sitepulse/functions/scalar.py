"""Scalar functions of the reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MS_PER_DAY = 86_400_000


def bucket(value: Column, width: float, scale: float) -> Column:
    """``floor(value / width) * scale`` as an integer: the lower edge of a bin."""
    return (F.floor(value / F.lit(width)) * F.lit(scale)).cast("bigint")


def round_to_int(value: Column) -> Column:
    """Cast to an integer by rounding half away from zero (a plain cast truncates)."""
    return F.round(value).cast("bigint")


def kilobytes(value: Column) -> Column:
    """Whole kilobytes, truncated toward zero."""
    return (value / F.lit(1024)).cast("bigint")


def safe_divide(a: Column, b: Column) -> Column:
    """``a / b``, NULL when ``b`` is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(safe_divide(part * F.lit(100), whole), places)


def report_date(day: Column) -> Column:
    """``YYYY_MM_DD`` text."""
    return F.date_format(day, "yyyy_MM_dd")


def epoch_ms(day: Column) -> Column:
    """Milliseconds since the epoch at midnight of the day."""
    return F.unix_date(day).cast("bigint") * F.lit(MS_PER_DAY).cast("bigint")


def parse_report_date(text: Column) -> Column:
    """Inverse of ``report_date``."""
    return F.to_date(F.regexp_replace(text, "_", "-"))


def month_date(yyyymm: Column) -> Column:
    """First day of a ``yyyymm`` number."""
    return F.to_date(F.regexp_replace(yyyymm.cast("string"), r"^(\d{4})(\d{2})$", "$1-$2-01"))


def month_label(yyyymm: Column) -> Column:
    """``YYYY_MM_01`` text of a ``yyyymm`` number."""
    return F.regexp_replace(yyyymm.cast("string"), r"(\d{4})(\d{2})", "$1_$2_01")


def drop_last_char(text: Column) -> Column:
    """Drop the last character: the trailing slash of a root page."""
    return F.substring(text, F.lit(1), F.length(text) - 1)


def shard_date(suffix: Column) -> Column:
    """Date text of a shard suffix that lost its century: ``18_03_01_...`` -> ``2018_03_01``."""
    return F.concat(F.lit("20"), F.substring(suffix, 1, 8))


def url_shard(url: Column, shards: int = 4) -> Column:
    """SHA-256 of the URL modulo a power of two up to 16; the last hex digit decides it."""
    if shards not in (1, 2, 4, 8, 16):
        raise ValueError("shards must be a power of two up to 16")
    last_digit = F.substring(F.sha2(url.cast("binary"), 256), 64, 1)
    return F.conv(last_digit, 16, 10).cast("int") % F.lit(shards)


def first_line(text: Column) -> Column:
    return F.regexp_extract(text, r"^([^\n]*)", 1)


def without_trailing_services(text: Column) -> Column:
    """Drop the tail of a comma list from the first ``, key = `` on, as written in old headers."""
    return F.regexp_extract(text, r"^([^\n]*?)(?:, [^ \n]* = [^\n]*)?$", 1)


def advertises_http3(header: Column) -> Column:
    """An ``alt-svc`` header value offers a released or final-draft HTTP/3."""
    offered = without_trailing_services(first_line(header))
    return F.coalesce(offered.like("%h3=%") | offered.like("%h3-29=%"), F.lit(False))


def one_if(flag: Column) -> Column:
    """1 where the flag is true, else 0; NULL counts as false."""
    return F.when(flag, F.lit(1)).otherwise(F.lit(0))
