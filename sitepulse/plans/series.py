"""Time-series reports. Any number of metrics and lenses share one scan."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sitepulse.functions import rum, scalar
from sitepulse.operators import joins, timeseries as ts
from sitepulse.plans import lens as lenses_, metrics as m
from sitepulse.plans.facts import page_facts, request_facts
from sitepulse.plans.lens import Lens
from sitepulse.plans.tables import CrawlTables, scan

KEYS = ("lens", "date", "client")
# Every measure a report may hold; a report uses some of them.
MEASURES = {
    **{name: "double" for name in ts.QUANTILE_NAMES},
    "num_urls": "bigint",
    "percent": "double",
    "urls": "bigint",
}
COLUMNS = ("lens", "metric", "date", "timestamp", "client", *MEASURES)
REPORT_MEASURES = {
    m.Quantiles: ts.QUANTILE_NAMES,
    m.PassRate: ("percent",),
    m.FeatureShare: ("num_urls", "percent"),
    m.PageCount: ("urls",),
    m.LazyImages: ("percent",),
    m.RequestShare: ("percent",),
    m.RumShare: ("percent",),
    m.RumVitals: ("percent",),
}


@dataclass(frozen=True)
class _Plan:
    """How one metric is computed inside a shared aggregate.

    ``condition`` limits the rows it reads; ``aggregates`` are built over rows that satisfy it;
    ``measures`` turn them into report values.
    """

    name: str
    facts: tuple[str, ...]
    condition: Column
    aggregates: Callable[[Column], dict[str, Column]]
    measures: dict[str, Column]
    keep: Column | None = None


def _since(floor: str | None) -> Column:
    return F.lit(True) if floor is None else F.col("date") >= F.to_date(F.lit(floor))


def _plan(metric) -> _Plan:
    name = metric.name
    if isinstance(metric, m.Quantiles):
        condition, facts = _since(metric.floor), [metric.fact]
        if metric.positive:
            condition = condition & F.coalesce(F.col(metric.fact) > 0, F.lit(False))
        if metric.needs_lighthouse:
            condition, facts = condition & F.col("has_lighthouse"), [*facts, "has_lighthouse"]
        sketch = F.col(f"{name}__sketch")
        columns = ts.quantile_columns(sketch, metric.scale, metric.places)
        return _Plan(
            name, tuple(facts), condition,
            lambda c: {f"{name}__sketch": ts.quantiles(F.when(c, F.col(metric.fact)), metric.buckets)},
            dict(zip(ts.QUANTILE_NAMES, columns)),
            sketch.isNotNull() if metric.drop_empty else None,
        )
    if isinstance(metric, m.PassRate):
        score = F.col(f"score_{metric.audit}")
        present = "lighthouse_not_null" if metric.allow_empty else "has_lighthouse"
        condition = _since(metric.floor) & F.col(present)
        if metric.only_audited:
            condition = condition & score.isNotNull()
        passed = score.isin("true", "1")
        return _Plan(
            name, (f"score_{metric.audit}", present), condition,
            lambda c: {f"{name}__passed": ts.count_where(passed & c)},
            {"percent": scalar.percent(F.col(f"{name}__passed"), F.col(f"{name}__rows"))},
        )
    if isinstance(metric, m.FeatureShare):
        used = ts.matches(
            F.col("features"),
            lambda f: F.coalesce(f["id"] == metric.id, F.lit(False))
            | F.coalesce(f["feature"] == metric.feature, F.lit(False)),
        )
        counted = F.filter(used, lambda f: f["id"].isNotNull()) if metric.by_id else used
        num, rows = F.col(f"{name}__num"), F.col(f"{name}__unnested")
        return _Plan(
            name, ("features",), _since(metric.floor),
            lambda c: {
                f"{name}__num": F.sum(F.when(c, F.size(counted))),
                f"{name}__unnested": F.sum(F.when(c, ts.left_unnest_rows(used))),
            },
            {"num_urls": num, "percent": F.round(scalar.safe_divide(num, rows) * 100, 5)},
        )
    if isinstance(metric, m.PageCount):
        return _Plan(
            name, (), _since(metric.floor), lambda c: {}, {"urls": F.col(f"{name}__rows")}
        )
    raise TypeError(f"not a page series: {metric!r}")


def _long(wide: DataFrame, rows: dict[str, tuple[Column, dict[str, Column]]]) -> DataFrame:
    """Turn one wide aggregate row per key into one row per metric that has a result."""
    missing = {column: F.lit(None).cast(dtype).alias(column) for column, dtype in MEASURES.items()}
    entries = []
    for name, (keep, measures) in rows.items():
        given = {column: value.cast(MEASURES[column]).alias(column) for column, value in measures.items()}
        entries.append(F.when(keep, F.struct(F.lit(name).alias("metric"), *{**missing, **given}.values())))
    exploded = wide.select(*KEYS, F.explode(F.array_compact(F.array(*entries))).alias("m"))
    return exploded.select(
        "lens",
        "m.metric",
        scalar.report_date(F.col("date")).alias("date"),
        scalar.epoch_ms(F.col("date")).alias("timestamp"),
        "client",
        *[F.col(f"m.{column}").alias(column) for column in MEASURES],
    )


def page_series(
    tables: CrawlTables, metrics: Sequence, lenses: Sequence[Lens], after: str | None = None, until: str | None = None
) -> DataFrame:
    """Quantiles, pass rates, feature shares and counts of root pages from one aggregate.

    Each metric guards its own aggregates. A filter on parsed values would serve one metric only,
    and Spark would move it below the parse and parse twice.
    """
    plans = [_plan(metric) for metric in metrics]
    pages = scan(tables.pages, after=after, until=until, root_only=True)
    floors = [getattr(metric, "floor", None) for metric in metrics]
    if all(floors):
        pages = scan(pages, since=min(floors))
    rows = page_facts(pages, [fact for plan in plans for fact in plan.facts])
    rows = lenses_.tag(rows, lenses)
    aggregates: dict[str, Column] = {}
    for plan in plans:
        aggregates[f"{plan.name}__rows"] = ts.count_where(plan.condition)
        aggregates.update(plan.aggregates(plan.condition))
    wide = rows.groupBy(*KEYS).agg(*[value.alias(name) for name, value in aggregates.items()])
    results = {}
    for plan in plans:
        keep = F.col(f"{plan.name}__rows") > 0
        results[plan.name] = (keep if plan.keep is None else keep & plan.keep, plan.measures)
    return _long(wide, results)


def lazy_image_series(
    tables: CrawlTables, metric: m.LazyImages, lenses: Sequence[Lens], after: str | None = None, until: str | None = None
) -> DataFrame:
    """Share of distinct pages with an image loaded lazily."""
    pages = scan(scan(tables.pages, after=after, until=until, root_only=True), after=metric.after)
    rows = lenses_.tag(page_facts(pages, ["loading_attributes"]), lenses)
    lazy = F.exists(F.col("loading_attributes"), lambda a: F.lower(a) == "lazy")
    wide = ts.distinct_shares(rows, KEYS, "page", {"lazy": lazy})
    return _long(wide, {metric.name: (F.lit(True), {"percent": scalar.percent(F.col("lazy"), F.col("keys"))})})


def request_series(
    tables: CrawlTables, metrics: Sequence[m.RequestShare], lenses: Sequence[Lens], after: str | None = None, until: str | None = None
) -> DataFrame:
    """Shares of requests on crawled pages. All metrics share one join, after summing per page."""
    floor = min(metric.floor for metric in metrics)
    pages, requests = (
        scan(scan(table, after=after, until=until, root_only=True), since=floor)
        for table in (tables.pages, tables.requests)
    )
    kinds = {metric.what for metric in metrics}
    requests = request_facts(requests, ["http_version"] if kinds & {"http2", "http3"} else [])
    one = F.lit(1).cast("bigint")
    offers = ts.matches(F.col("response_headers"), lambda h: F.coalesce(h["name"] == "alt-svc", F.lit(False)))
    in_use = F.coalesce(F.col("http_version").isin(*m.HTTP3_VERSIONS), F.lit(False))
    unnested = ts.left_unnest_rows(offers).cast("bigint")
    able = F.size(F.filter(offers, lambda h: scalar.advertises_http3(h["value"]))).cast("bigint")
    measures = {
        "http2": {"http2_rows": one, "http2_hits": scalar.one_if(F.col("http_version") == "HTTP/2").cast("bigint")},
        "http3": {"http3_rows": unnested, "http3_hits": F.when(in_use, unnested).otherwise(able)},
        "https": {"https_rows": one, "https_hits": scalar.one_if(F.col("url").startswith("https")).cast("bigint")},
    }
    joined = joins.sums_on_pages(
        requests,
        pages,
        {name: value for kind in sorted(kinds) for name, value in measures[kind].items()},
        subsets=lenses_.subsets(lenses),
    )
    sums = [F.sum(name).alias(name) for kind in sorted(kinds) for name in measures[kind]]
    wide = joined.groupBy(*KEYS).agg(*sums)
    return _long(
        wide,
        {
            metric.name: (
                _since(metric.floor),
                {"percent": scalar.percent(F.col(f"{metric.what}_hits"), F.col(f"{metric.what}_rows"))},
            )
            for metric in metrics
        },
    )


def _tag_summary(summary: DataFrame, pages: DataFrame | None, lenses: Sequence[Lens]) -> DataFrame:
    """Add a ``lens`` column. All lenses share one join to the sites crawled on the date."""
    if len(lenses) == 1:
        return lenses[0].restrict_summary(summary, pages).withColumn("lens", F.lit(lenses[0].name))
    chosen = {
        f"_in_{lens.name}": lens.on_pages() if lens.technology is not None else F.col("rank") == F.lit(lens.rum_rank)
        for lens in lenses
        if lens.technology is not None or lens.rum_rank is not None
    }
    in_any = F.lit(False)
    for flag in chosen.values():
        in_any = in_any | F.coalesce(flag, F.lit(False))
    sites = (
        scan(pages, since="2010-11-15", root_only=True)
        .where(in_any)
        .groupBy(
            scalar.drop_last_char(F.col("page")).alias("origin"),
            rum.device_of(F.col("client")).alias("device"),
            "date",
        )
        .agg(*[F.max(F.coalesce(flag, F.lit(False))).alias(name) for name, flag in chosen.items()])
    )
    tagged = summary.join(sites, ["origin", "device", "date"], "left")
    tags = [
        F.when(F.col(f"_in_{lens.name}"), F.lit(lens.name)) if f"_in_{lens.name}" in chosen else F.lit(lens.name)
        for lens in lenses
    ]
    return tagged.withColumn("lens", F.explode(F.array_compact(F.array(*tags))))


def rum_series(
    tables: CrawlTables, metrics: Sequence[m.RumShare | m.RumVitals], lenses: Sequence[Lens]
) -> DataFrame:
    """Shares of sites in the device summary, all metrics from one aggregate per site.

    Always a full run: the monthly summary is small beside the crawl.
    """
    rows = tables.rum_summary.where(F.col("device").isin("desktop", "phone"))
    flags, present, results = {}, {}, {}
    for metric in metrics:
        hits, whole, seen = (f"{metric.name}__{part}" for part in ("hits", "whole", "seen"))
        if isinstance(metric, m.RumVitals):
            used = (
                (F.col("yyyymm") > metric.after_month)
                & F.col("p75_lcp").isNotNull()
                & F.col("p75_cls").isNotNull()
            )
            flags[hits], flags[whole] = used & m.passes_vitals(), used
        else:
            triple = [F.col(c) for c in metric.triple]
            used = F.lit(True) if metric.since_month is None else F.col("yyyymm") >= metric.since_month
            flags[hits] = used & (rum.is_poor if metric.poor else rum.is_good)(*triple)
            flags[whole] = used & rum.is_non_zero(*triple)
        present[seen] = used
        share = scalar.safe_divide(F.col(hits), F.col(whole)) * 100
        results[metric.name] = (F.col(seen) > 0, {"percent": share})
    if len(metrics) == 1:
        rows = rows.where(present[f"{metrics[0].name}__seen"])
    by_site = any(lens.technology is not None or lens.rum_rank is not None for lens in lenses)
    rows = _tag_summary(rows, tables.pages if by_site else None, lenses)
    # The report date comes from the month number, whatever date the row carries.
    rows = rows.withColumns(
        {"date": scalar.month_date(F.col("yyyymm")), "client": rum.client_of(F.col("device"))}
    )
    return _long(ts.distinct_shares(rows, KEYS, "origin", flags, present), results)


def series(
    tables: CrawlTables, metrics: Sequence, lenses: Sequence[Lens], after: str | None = None, until: str | None = None
) -> DataFrame | None:
    """All given series in long form. ``after`` and ``until`` bound the crawl dates only."""
    on_pages = [x for x in metrics if isinstance(x, (m.Quantiles, m.PassRate, m.FeatureShare, m.PageCount))]
    on_requests = [x for x in metrics if isinstance(x, m.RequestShare)]
    on_rum = [x for x in metrics if m.is_rum(x)]
    parts = [
        lazy_image_series(tables, x, lenses, after, until) for x in metrics if isinstance(x, m.LazyImages)
    ]
    if on_pages:
        parts.append(page_series(tables, on_pages, lenses, after, until))
    if on_requests:
        parts.append(request_series(tables, on_requests, lenses, after, until))
    if on_rum:
        parts.append(rum_series(tables, on_rum, lenses))
    result = None
    for part in parts:
        result = part if result is None else result.unionByName(part)
    return result.select(*COLUMNS) if result is not None else None


def shape(long: DataFrame, metric) -> DataFrame:
    """One metric's rows in report columns, without ordering."""
    return long.where(F.col("metric") == metric.name).select(
        "lens", "date", "timestamp", "client", *REPORT_MEASURES[type(metric)]
    )


def report(
    tables: CrawlTables, name: str, lens: str | None = None, after: str | None = None, until: str | None = None
) -> DataFrame:
    """One time-series report as published, newest date first."""
    metric = m.SERIES[name]
    chosen = [lenses_.get(lens or lenses_.BASE)]
    rows = shape(series(tables, [metric], chosen, after, until), metric).drop("lens")
    extra = [F.col("num_urls").desc()] if isinstance(metric, m.FeatureShare) else []
    return ts.newest_first(rows, *extra)
