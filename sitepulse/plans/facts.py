"""Typed facts: the numbers and flags the reports read, extracted from the JSON columns.

A report on the raw table extracts only the facts it needs, with one parse per JSON column. For
repeated reporting, ``write_page_facts`` extracts all of them once into typed columns; reports
then read a few plain columns and no JSON at all. Every report accepts either table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sitepulse.functions import jsoncols
from sitepulse.functions.jsoncols import ANY, NAMED_SCORES, NUMBER, Path


@dataclass(frozen=True)
class Fact:
    """A value computed from members of one JSON column."""

    source: str
    paths: tuple[tuple[Path, T.DataType], ...]
    value: Callable[..., Column]


def _number(source: str, *path: str) -> Fact:
    return Fact(source, ((path, NUMBER),), lambda x: x)


def _integer(source: str, *path: str) -> Fact:
    return Fact(source, ((path, NUMBER),), jsoncols.as_integer)


def _first_number(source: str, *paths: Path) -> Fact:
    """The first of several members that holds a number: report formats changed over the years."""
    return Fact(source, tuple((p, NUMBER) for p in paths), lambda *xs: F.coalesce(*xs))


def _savings(audit: str) -> Fact:
    """Bytes an audit says can be saved; early versions gave kilobytes."""
    return Fact(
        "lighthouse",
        (
            (("audits", audit, "details", "overallSavingsBytes"), NUMBER),
            (("audits", audit, "extendedInfo", "value", "wastedKb"), NUMBER),
        ),
        lambda size, kb: F.coalesce(
            jsoncols.as_integer(size), jsoncols.as_integer(kb) * F.lit(1024)
        ),
    )


def _score(audit: str) -> Fact:
    return Fact("lighthouse", ((("audits", audit, "score"), ANY),), jsoncols.lax_string)


# JSON members of the page documents.
SUMMARY_NUMBERS = (
    "bytesCss", "bytesFont", "bytesHtml", "bytesImg", "bytesJS", "bytesOther", "bytesTotal", "bytesVideo",
    "reqCss", "reqFont", "reqHtml", "reqImg", "reqJS", "reqOther", "reqTotal", "reqVideo",
    "onLoad", "onContentLoaded",
)
AUDITS = (
    "button-name", "color-contrast", "image-alt", "label", "link-name", "canonical",
    "font-display", "hreflang", "font-size", "link-text",
)

PAGE_FACTS: dict[str, Fact] = {
    **{name: _number("summary", name) for name in SUMMARY_NUMBERS},
    "connections": _number("summary", "_connections"),
    "speed_index": _number("payload", "_SpeedIndex"),
    "gzip_savings": _number("payload", "_gzip_savings"),
    "image_savings": _number("payload", "_image_savings"),
    "compile_ms": _integer("payload", "_cpu.v8.compile"),
    "first_paint_ms": _number("payload", "_chromeUserTiming.firstContentfulPaint"),
    "bootup_ms": _first_number(
        "lighthouse", ("audits", "bootup-time", "numericValue"), ("audits", "bootup-time", "rawValue")
    ),
    # The two reports fall back in a different order.
    "interactive_ms": _first_number(
        "lighthouse",
        ("audits", "interactive", "numericValue"),
        ("audits", "consistently-interactive", "rawValue"),
        ("audits", "interactive", "rawValue"),
    ),
    "interactive_series_ms": _first_number(
        "lighthouse",
        ("audits", "interactive", "numericValue"),
        ("audits", "interactive", "rawValue"),
        ("audits", "consistently-interactive", "rawValue"),
    ),
    "offscreen_bytes": _savings("offscreen-images"),
    "unoptimized_bytes": _savings("uses-optimized-images"),
    "a11y_score": Fact(
        "lighthouse",
        ((("categories", "accessibility", "score"), ANY), (("reportCategories",), NAMED_SCORES)),
        lambda new, old: F.coalesce(
            jsoncols.lax_float(new) * F.lit(100), jsoncols.named_score(old, "Accessibility")
        ),
    ),
    **{f"score_{audit}": _score(audit) for audit in AUDITS},
}

# Facts read from a column as a whole.
COLUMN_FACTS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "has_lighthouse": ("lighthouse", jsoncols.is_present),
    "lighthouse_not_null": ("lighthouse", lambda doc: doc.isNotNull()),
    "loading_attributes": (
        "custom_metrics",
        lambda c: jsoncols.array_at(c["other"], "img-loading-attr"),
    ),
}

REQUEST_FACTS: dict[str, Fact] = {
    "http_version": Fact("summary", ((("respHttpVersion",), ANY),), jsoncols.lax_string),
    "script_ms": _number("payload", "_cpu.EvaluateScript"),
}

PAGE_COLUMNS = ("date", "client", "is_root_page", "page", "rank", "technologies", "features")


def _with_facts(
    rows: DataFrame,
    names: Iterable[str],
    facts: dict[str, Fact],
    column_facts: dict[str, tuple[str, Callable[[Column], Column]]],
    keep: Iterable[str],
) -> DataFrame:
    wanted = [name for name in dict.fromkeys(names) if name not in rows.columns]
    paths: dict[str, dict[Path, T.DataType]] = {}
    for name in wanted:
        if name in facts:
            paths.setdefault(facts[name].source, {}).update(facts[name].paths)
    parsed = rows.withColumns(
        {
            f"_{source}": jsoncols.parse(F.col(source), members.items())
            for source, members in paths.items()
        }
    )

    def value(name: str) -> Column:
        if name in facts:
            fact = facts[name]
            return fact.value(
                *[jsoncols.member(F.col(f"_{fact.source}"), path) for path, _ in fact.paths]
            )
        source, build = column_facts[name]
        return build(F.col(source))

    kept = [c for c in dict.fromkeys([*keep, *names]) if c in rows.columns]
    return parsed.select(*kept, *[value(name).alias(name) for name in wanted])


def page_facts(pages: DataFrame, names: Iterable[str]) -> DataFrame:
    """Pages with the named facts beside their keys. Facts that are columns already are kept."""
    return _with_facts(pages, list(names), PAGE_FACTS, COLUMN_FACTS, PAGE_COLUMNS)


def request_facts(requests: DataFrame, names: Iterable[str]) -> DataFrame:
    """Requests with the named facts beside their keys and headers."""
    keep = ("date", "client", "is_root_page", "rank", "page", "url", "response_headers")
    return _with_facts(requests, list(names), REQUEST_FACTS, {}, keep)


def write_page_facts(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Extract every page fact once into a typed table, partitioned like the raw one."""
    _write(page_facts(pages, [*PAGE_FACTS, *COLUMN_FACTS]), path, mode)


def write_request_facts(requests: DataFrame, path: str, mode: str = "overwrite") -> None:
    _write(request_facts(requests, list(REQUEST_FACTS)), path, mode)


def _write(rows: DataFrame, path: str, mode: str) -> None:
    # The writer sorts what a task holds by date and client. Rebalanced, a task holds a share of bounded size, not all
    # that a split of the documents gave, and a (date, client) is written by as many tasks as its size asks for.
    (
        rows.hint("rebalance", "date", "client")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "client")
        .parquet(path)
    )

