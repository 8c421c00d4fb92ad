"""Small hand-made crawl tables."""

from __future__ import annotations

import datetime as dt
import json

from sitepulse.plans.tables import CrawlTables

PAGES = (
    "date date, client string, is_root_page boolean, page string, rank bigint, summary string, payload string, "
    "lighthouse string, custom_metrics struct<other: string>, features array<struct<id: string, feature: string>>, "
    "technologies array<struct<technology: string>>"
)
REQUESTS = (
    "date date, client string, is_root_page boolean, page string, rank bigint, url string, summary string, "
    "payload string, response_headers array<struct<name: string, value: string>>"
)
_BIN = "struct<histogram: struct<bin: array<struct<start: {0}, end: {0}, density: double>>>>"
_MS, _EXACT = _BIN.format("bigint"), _BIN.format("decimal(38,9)")
RUM = (
    f"yyyymm int, origin string, form_factor struct<name: string>, first_paint {_MS}, first_contentful_paint {_MS}, "
    f"largest_contentful_paint {_MS}, dom_content_loaded {_MS}, onload {_MS}, interaction_to_next_paint {_MS}, "
    f"layout_instability struct<cumulative_layout_shift: {_EXACT}>, "
    f"experimental struct<popularity: struct<rank: bigint>, time_to_first_byte: {_MS}>"
)
_SHARES = [f"{speed}_{n}" for n in ("dcl", "fcp", "fp", "ol", "ttfb", "lcp", "inp", "fid") for speed in ("fast", "avg", "slow")]
_SHARES += ["small_cls", "medium_cls", "large_cls", "p75_lcp", "p75_cls", "p75_inp", "p75_fid"]
RUM_SUMMARY = "yyyymm int, date date, device string, origin string, " + ", ".join(f"{c} double" for c in _SHARES)

DAY = dt.date(2023, 5, 1)


def page(url="https://a.example/", client="desktop", date=DAY, root=True, rank=1000, summary=None, payload=None,
         lighthouse=None, other=None, features=None, technologies=None):
    def text(value):
        return value if value is None or isinstance(value, str) else json.dumps(value)

    return (
        date, client, root, url, rank, text(summary or {}), text(payload or {}), text(lighthouse),
        (text(other),), features, None if technologies is None else [(t,) for t in technologies],
    )


def request(page="https://a.example/", client="desktop", date=DAY, root=True, rank=1000, url="https://x/",
            summary=None, payload=None, headers=None):
    return (date, client, root, page, rank, url, json.dumps(summary or {}), json.dumps(payload or {}), headers)


def rum(origin="https://a.example", device="desktop", month=202305, rank=1000, **bins):
    def wrap(name):
        return None if bins.get(name) is None else ((bins[name],),)

    return (
        month, origin, (device,), wrap("fp"), wrap("fcp"), wrap("lcp"), wrap("dcl"), wrap("ol"), wrap("inp"),
        (wrap("cls"),), ((rank,), wrap("ttfb")),
    )


def summary(origin="https://a.example", device="desktop", month=202305, **shares):
    date = dt.date(month // 100, month % 100, 1)
    return (month, date, device, origin, *[None if shares.get(c) is None else float(shares[c]) for c in _SHARES])


def tables(spark, pages=(), requests=(), rum_rows=(), summaries=()) -> CrawlTables:
    return CrawlTables(
        spark.createDataFrame(list(pages), PAGES),
        spark.createDataFrame(list(requests), REQUESTS),
        spark.createDataFrame(list(rum_rows), RUM),
        spark.createDataFrame(list(summaries), RUM_SUMMARY),
    )
