"""The metric registry: every report as data, grouped in a few families."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from fnmatch import fnmatchcase

from pyspark.sql import Column, functions as F

from sitepulse.functions import jsoncols, rum, scalar


@dataclass(frozen=True)
class CrawlHistogram:
    """Histogram of one fact of the root pages of a crawl."""

    name: str
    fact: str
    bin: Callable[[Column], Column]
    keep_null: bool = True
    minimum: float | None = None
    positive: bool = False
    floor: str | None = None
    whole_bins: bool = True
    source: str = "pages"


@dataclass(frozen=True)
class RumHistogram:
    """Histogram summed over the given bins of every site."""

    name: str
    path: str
    # Spread over steps of this width, up to this far beyond the bin start; None keeps bins.
    width: str | None = None
    clamp: str | None = None
    scale: int = 1
    # Bin edges are exact decimals instead of whole milliseconds.
    exact_edges: bool = False


@dataclass(frozen=True)
class Quantiles:
    """p10 .. p90 of one fact per date and client."""

    name: str
    fact: str
    scale: float = 1
    floor: str | None = None
    buckets: int = 1001
    positive: bool = False
    needs_lighthouse: bool = False
    drop_empty: bool = False
    places: int | None = 2


@dataclass(frozen=True)
class PassRate:
    """Percent of audited pages that pass an audit."""

    name: str
    audit: str
    floor: str
    only_audited: bool = False
    allow_empty: bool = False


@dataclass(frozen=True)
class FeatureShare:
    """Pages using a browser feature, found by id or by name."""

    name: str
    id: str
    feature: str
    floor: str = "2016-11-15"
    by_id: bool = True


@dataclass(frozen=True)
class PageCount:
    name: str
    floor: str


@dataclass(frozen=True)
class LazyImages:
    """Percent of pages with a lazily loaded image."""

    name: str
    after: str


@dataclass(frozen=True)
class RequestShare:
    """Percent of requests on crawled pages: ``http2``, ``http3`` or ``https``."""

    name: str
    what: str
    floor: str


@dataclass(frozen=True)
class RumShare:
    """Percent of sites whose experience is good (or poor) by a triple of shares."""

    name: str
    triple: tuple[str, str, str]
    poor: bool = False
    since_month: int | None = None


@dataclass(frozen=True)
class RumVitals:
    """Percent of sites that pass all vitals."""

    name: str
    after_month: int


def _binned(width: float, scale: float) -> Callable[[Column], Column]:
    return lambda x: scalar.bucket(x, width, scale)


def _floored(width: float) -> Callable[[Column], Column]:
    return lambda x: F.floor(x / F.lit(width)).cast("double")


# Names, members, bin widths, floors and quirks of the reports.
_KB10, _KB100 = _binned(10240, 10), _binned(102400, 100)

CRAWL_HISTOGRAMS = (
    CrawlHistogram("bootupJs", "bootup_ms", lambda x: F.floor(x / 100) / F.lit(10), keep_null=False, whole_bins=False),
    CrawlHistogram("bytesCss", "bytesCss", _KB10),
    CrawlHistogram("bytesFont", "bytesFont", _KB10),
    CrawlHistogram("bytesHtml", "bytesHtml", _KB10),
    CrawlHistogram("bytesImg", "bytesImg", _KB100),
    CrawlHistogram("bytesJs", "bytesJS", _KB10),
    CrawlHistogram("bytesOther", "bytesOther", _KB10),
    CrawlHistogram("bytesTotal", "bytesTotal", _KB100),
    CrawlHistogram("bytesVideo", "bytesVideo", _KB10),
    CrawlHistogram("compileJs", "compile_ms", lambda x: x, keep_null=False, minimum=0),
    CrawlHistogram("dcl", "onContentLoaded", _floored(1000), positive=True, whole_bins=False),
    CrawlHistogram(
        "evalJs", "script_ms", lambda x: scalar.round_to_int(x / 20) * 20,
        keep_null=False, minimum=0, source="requests",
    ),
    CrawlHistogram("fcp", "first_paint_ms", _binned(1000, 1), keep_null=False, minimum=0),
    CrawlHistogram("gzipSavings", "gzip_savings", _binned(2048, 2), keep_null=False),
    CrawlHistogram("imgSavings", "image_savings", _KB10, keep_null=False),
    CrawlHistogram("offscreenImages", "offscreen_bytes", _KB10, keep_null=False, floor="2022-03-01"),
    CrawlHistogram("ol", "onLoad", _floored(1000), positive=True, whole_bins=False),
    CrawlHistogram("optimizedImages", "unoptimized_bytes", _KB10, keep_null=False, floor="2022-03-01"),
    *(
        CrawlHistogram(name, fact, lambda x: x, whole_bins=False)
        for name, fact in (
            ("reqCss", "reqCss"), ("reqFont", "reqFont"), ("reqHtml", "reqHtml"), ("reqImg", "reqImg"),
            ("reqJs", "reqJS"), ("reqOther", "reqOther"), ("reqVideo", "reqVideo"),
        )
    ),
    CrawlHistogram("reqTotal", "reqTotal", lambda x: (F.floor(x / 10) * 10).cast("double"), whole_bins=False),
    CrawlHistogram("speedIndex", "speed_index", _binned(1000, 1000), keep_null=False),
    CrawlHistogram("tcp", "connections", jsoncols.as_integer, positive=True),
    CrawlHistogram("ttci", "interactive_ms", _binned(1000, 1), keep_null=False, floor="2022-03-01"),
)

_MS = {"width": "100", "clamp": "5000", "scale": 1000}
RUM_HISTOGRAMS = (
    RumHistogram("cruxCls", "layout_instability.cumulative_layout_shift", "0.01", "10", exact_edges=True),
    RumHistogram("cruxDcl", "dom_content_loaded", **_MS),
    RumHistogram("cruxFcp", "first_contentful_paint", **_MS),
    RumHistogram("cruxFp", "first_paint", **_MS),
    RumHistogram("cruxInp", "interaction_to_next_paint"),
    RumHistogram("cruxLcp", "largest_contentful_paint", **_MS),
    RumHistogram("cruxOl", "onload", **_MS),
    RumHistogram("cruxTtfb", "experimental.time_to_first_byte"),
)

_START = "2010-11-15"
QUANTILE_SERIES = (
    *(
        Quantiles(name, fact, 1024, _START, positive=True)
        for name, fact in (
            ("bytesCss", "bytesCss"), ("bytesFont", "bytesFont"), ("bytesHtml", "bytesHtml"),
            ("bytesImg", "bytesImg"), ("bytesJs", "bytesJS"), ("bytesOther", "bytesOther"),
            ("bytesTotal", "bytesTotal"), ("bytesVideo", "bytesVideo"),
        )
    ),
    *(
        Quantiles(name, fact, 1, _START, positive=True)
        for name, fact in (
            ("reqCss", "reqCss"), ("reqFont", "reqFont"), ("reqHtml", "reqHtml"), ("reqImg", "reqImg"),
            ("reqJs", "reqJS"), ("reqOther", "reqOther"), ("reqTotal", "reqTotal"), ("reqVideo", "reqVideo"),
        )
    ),
    Quantiles("dcl", "onContentLoaded", 1000, _START, positive=True),
    Quantiles("ol", "onLoad", 1000, _START, positive=True),
    # Milliseconds over 1024, as published.
    Quantiles("fcp", "first_paint_ms", 1024, "2016-12-15", drop_empty=True),
    Quantiles("gzipSavings", "gzip_savings", 1024),
    Quantiles("imgSavings", "image_savings", 1024, "2016-01-01"),
    Quantiles("offscreenImages", "offscreen_bytes", 1024, "2017-06-01"),
    Quantiles("optimizedImages", "unoptimized_bytes", 1024, "2017-06-01"),
    Quantiles("speedIndex", "speed_index", 1000, "2016-01-01"),
    Quantiles("tcp", "connections", 1, _START, positive=True, places=None),
    Quantiles("bootupJs", "bootup_ms", 1000, "2017-06-01", buckets=1000, needs_lighthouse=True),
    Quantiles("ttci", "interactive_series_ms", 1000, "2016-01-01", buckets=1000),
    Quantiles("a11yScores", "a11y_score", 1, "2017-06-01", buckets=1000, needs_lighthouse=True),
)

PASS_RATES = (
    PassRate("a11yButtonName", "button-name", "2017-06-01"),
    PassRate("a11yColorContrast", "color-contrast", "2017-06-01"),
    PassRate("a11yImageAlt", "image-alt", "2017-06-01"),
    PassRate("a11yLabel", "label", "2017-06-01"),
    PassRate("a11yLinkName", "link-name", "2017-06-01"),
    PassRate("canonical", "canonical", "2017-06-01"),
    PassRate("fontDisplay", "font-display", "2017-06-01", only_audited=True),
    PassRate("hreflang", "hreflang", "2017-06-01", only_audited=True),
    PassRate("legible", "font-size", "2017-12-15", only_audited=True, allow_empty=True),
    PassRate("linkText", "link-text", "2017-11-15", only_audited=True, allow_empty=True),
)

# Two of them share an id, as published.
FEATURE_SHARES = (
    FeatureShare("asyncClipboardRead", "2369", "AsyncClipboardAPIRead"),
    FeatureShare("badgeClear", "2727", "BadgeClear"),
    FeatureShare("badgeSet", "2726", "BadgeSet"),
    FeatureShare("getInstalledRelatedApps", "1870", "V8Navigator_GetInstalledRelatedApps_Method"),
    FeatureShare("idleDetection", "2834", "IdleDetectionStart"),
    FeatureShare("notificationTriggers", "3017", "NotificationShowTrigger"),
    FeatureShare("periodicBackgroundSync", "2930", "PeriodicBackgroundSync"),
    FeatureShare("periodicBackgroundSyncRegister", "2931", "PeriodicBackgroundSyncRegister"),
    FeatureShare("quicTransport", "3184", "QuicTransport"),
    FeatureShare("screenWakeLock", "3005", "WakeLockAcquireScreenLock"),
    FeatureShare("storageEstimate", "1371", "DurableStorageEstimate"),
    FeatureShare("storagePersist", "3018", "DurableStoragePersist"),
    FeatureShare("swControlledPages", "990", "ServiceWorkerControlledPage", by_id=False),
    FeatureShare("webSocketStream", "3018", "WebSocketStreamConstructor", by_id=False),
)

REQUEST_SHARES = (
    RequestShare("h2", "http2", "2016-07-15"),
    RequestShare("h3", "http3", "2020-01-01"),
    RequestShare("pctHttps", "https", "2016-01-01"),
)
OTHER_SERIES = (LazyImages("imgLazy", "2016-01-01"), PageCount("numUrls", _START))

HTTP3_VERSIONS = ("HTTP/3", "h3", "h3-29")
INP_REPLACES_FID = 202402


def _triple(name: str) -> tuple[str, str, str]:
    if name == "cls":
        return ("small_cls", "medium_cls", "large_cls")
    return (f"fast_{name}", f"avg_{name}", f"slow_{name}")


RUM_SHARES = (
    RumShare("cruxFastDcl", _triple("dcl")),
    RumShare("cruxFastFcp", _triple("fcp")),
    RumShare("cruxFastFp", _triple("fp")),
    RumShare("cruxFastInp", _triple("inp"), since_month=202202),
    RumShare("cruxFastLcp", _triple("lcp"), since_month=201909),
    RumShare("cruxFastOl", _triple("ol")),
    RumShare("cruxFastTtfb", _triple("ttfb")),
    RumShare("cruxLargeCls", _triple("cls"), poor=True, since_month=201905),
    RumShare("cruxSmallCls", _triple("cls"), since_month=201905),
    RumShare("cruxSlowFcp", _triple("fcp"), poor=True),
    RumShare("cruxSlowInp", _triple("inp"), poor=True, since_month=202202),
    RumShare("cruxSlowLcp", _triple("lcp"), poor=True, since_month=201909),
    RumShare("cruxSlowTtfb", _triple("ttfb"), poor=True),
)
RUM_VITALS = RumVitals("cruxPassesCWV", after_month=201909)

PAGE_SERIES = (*QUANTILE_SERIES, *PASS_RATES, *FEATURE_SHARES, *OTHER_SERIES)
HISTOGRAMS = {m.name: m for m in (*CRAWL_HISTOGRAMS, *RUM_HISTOGRAMS)}
SERIES = {m.name: m for m in (*PAGE_SERIES, *REQUEST_SHARES, *RUM_SHARES, RUM_VITALS)}


def is_rum(metric) -> bool:
    return isinstance(metric, (RumHistogram, RumShare, RumVitals))


def matching(registry: dict, pattern: str = "*") -> list:
    """Metrics whose name matches a glob, in registry order."""
    return [metric for name, metric in registry.items() if fnmatchcase(name, pattern)]


def passes_vitals() -> Column:
    """Good loading and stability, and good responsiveness where it was measured.

    The responsiveness measure changed with one month.
    """

    def good(name: str) -> Column:
        return rum.is_good(*[F.col(c) for c in _triple(name)])

    responsive = F.when(
        F.col("yyyymm") >= INP_REPLACES_FID, F.col("p75_inp").isNull() | good("inp")
    ).otherwise(F.col("p75_fid").isNull() | good("fid"))
    return responsive & good("lcp") & good("cls")
