"""Registered report queries (every metric, every lens) and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from contract import analogs as a
from sitepulse.plans import histograms, lens as lenses, metrics as m, series

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------- flat inputs in SQL




ORDERS_DATE = "CAST(date_trunc('month', o_orderdate) + INTERVAL 21 YEAR AS DATE)"
RUM_MONTH = "CAST(strftime(l_shipdate + INTERVAL 23 YEAR, '%Y%m') AS INTEGER)"
RUM_DATE = "CAST(date_trunc('month', l_shipdate + INTERVAL 23 YEAR) AS DATE)"


def pages_sql(extra: str = "") -> str:
    return (
        f"SELECT o_orderkey, o_custkey, o_totalprice, {ORDERS_DATE} AS date, {a.CLIENT} AS client, {a.IS_ROOT} AS is_root_page, "
        f"{a.PAGE} AS page, {a.RANK} AS rank{', ' + extra if extra else ''} FROM orders"
    )


def _has_technology(name: str) -> str:
    cases = [str(i) for i, names in enumerate(a.TECHNOLOGIES) if names and name in names]
    return f"{a.TECH_CASE} IN ({', '.join(cases)})"


def lens_sql(lens: lenses.Lens) -> str:
    if lens.technology:
        return _has_technology(lens.technology)
    return f"{a.RANK} <= {lens.max_rank}" if lens.max_rank else "TRUE"


FACTS_SQL = {
    **a.SUMMARY,
    "connections": a.SUMMARY["_connections"],
    "speed_index": a.PAYLOAD["_SpeedIndex"],
    "gzip_savings": a.PAYLOAD["_gzip_savings"],
    "image_savings": a.PAYLOAD["_image_savings"],
    "compile_ms": a.PAYLOAD["_cpu.v8.compile"],
    "first_paint_ms": a.PAYLOAD["_chromeUserTiming.firstContentfulPaint"],
}
LIGHTHOUSE_FACTS_SQL = {
    "bootup_ms": f"coalesce({a.BOOTUP[0]}, {a.BOOTUP[1]})",
    "interactive_ms": f"coalesce({a.INTERACTIVE[0]}, {a.CONSISTENTLY}, {a.INTERACTIVE[1]})",
    "interactive_series_ms": f"coalesce({a.INTERACTIVE[0]}, {a.INTERACTIVE[1]}, {a.CONSISTENTLY})",
    "offscreen_bytes": f"coalesce({a.OFFSCREEN[0]}, 1024 * ({a.OFFSCREEN[1]}))",
    "unoptimized_bytes": f"coalesce({a.UNOPTIMIZED[0]}, 1024 * ({a.UNOPTIMIZED[1]}))",
    "a11y_score": f"coalesce({a.A11Y[0]} * 100, {a.A11Y[1]})",
}
HAS_LIGHTHOUSE = f"{a.LIGHTHOUSE_CASE} > 1"
LIGHTHOUSE_NOT_NULL = f"{a.LIGHTHOUSE_CASE} > 0"


def fact_sql(name: str) -> str:
    if name in LIGHTHOUSE_FACTS_SQL:
        return f"CASE WHEN {HAS_LIGHTHOUSE} THEN {LIGHTHOUSE_FACTS_SQL[name]} END"
    return FACTS_SQL[name]


def rounded(expression: str, places: int) -> str:
    """Rounds the shortest decimal text of a double, half away from zero."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,9)), {places}) AS DOUBLE)"


# ---------------------------------------------------------------- histograms

BIN_SQL = {
    **{n: "floor(x / 10240) * 10" for n in ("bytesCss", "bytesFont", "bytesHtml", "bytesJs", "bytesOther", "bytesVideo", "imgSavings", "offscreenImages", "optimizedImages")},
    "bytesImg": "floor(x / 102400) * 100",
    "bytesTotal": "floor(x / 102400) * 100",
    "bootupJs": "floor(x / 100) / 10",
    "compileJs": "x",
    "tcp": "x",
    "dcl": "floor(x / 1000)",
    "ol": "floor(x / 1000)",
    "fcp": "floor(x / 1000)",
    "ttci": "floor(x / 1000)",
    "gzipSavings": "floor(x / 2048) * 2",
    "reqTotal": "floor(x / 10) * 10",
    "speedIndex": "floor(x / 1000) * 1000",
    "evalJs": "round(x / 20) * 20",
}


def density_sql(counts: str, by: str = "date, client") -> str:
    """PDF and CDF over a ``counts`` CTE with columns by, bin, volume."""
    return f"""{counts},
p AS (SELECT *, volume / sum(volume) OVER (PARTITION BY {by}) AS pdf FROM counts)
SELECT {by}, bin, volume, round(pdf, 8) AS pdf,
  round(sum(pdf) OVER (PARTITION BY {by} ORDER BY bin NULLS FIRST), 8) AS cdf FROM p"""


def _histogram_sql(metric: m.CrawlHistogram, lens: lenses.Lens) -> str:
    where = ["is_root_page", lens_sql(lens).replace(a.RANK, "rank")]
    if metric.floor:
        where.append(f"date >= DATE '{metric.floor}'")
    if metric.positive:
        where.append("x > 0")
    having = []
    if not metric.keep_null:
        having.append("bin IS NOT NULL")
    if metric.minimum is not None:
        having.append(f"bin >= {metric.minimum}")
    kept = " WHERE " + " AND ".join(having) if having else ""
    dtype = "BIGINT" if metric.whole_bins else "DOUBLE"
    bin = BIN_SQL.get(metric.name, "x")
    if metric.source == "requests":
        rows = (
            f"SELECT q.*, {a.SCRIPT_MS} AS x FROM ({pages_sql()}) q JOIN lineitem ON l_orderkey = q.o_orderkey"
        )
        source = (
            f"p0 AS ({pages_sql()}), r0 AS ({rows}), "
            "src AS (SELECT r0.x, p0.* FROM r0 JOIN p0 USING (date, client, is_root_page, rank, page))"
        )
    else:
        source = f"src AS ({pages_sql(f'{fact_sql(metric.fact)} AS x')})"
    return density_sql(
        f"""WITH {source},
binned AS (SELECT date, client, CAST({bin} AS {dtype}) AS bin FROM src WHERE {' AND '.join(where)}),
counts AS (SELECT date, client, bin, count(*) AS volume FROM binned{kept} GROUP BY date, client, bin)"""
    )


def _histogram_query(name: str, lens: str = lenses.BASE) -> Query:
    """One metric for every date in one pass, which is what a backfill asks for."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        metric = m.HISTOGRAMS[name]
        long = histograms.histograms(a.tables(spark, sf_dir), [metric], [lenses.get(lens)])
        rows = histograms.shape(long, metric).drop("lens")
        volume = F.round("volume", 6) if m.is_rum(metric) else F.col("volume")
        return rows.withColumns({"volume": volume, "pdf": F.round("pdf", 8), "cdf": F.round("cdf", 8)})

    return query


def _lens_rum_sql(lens: lenses.Lens) -> str:
    """Condition on line items that keeps the pre-binned rows of a lens."""
    if lens.technology:
        return f"""({a.ORIGIN}, {a.DEVICE}, {RUM_MONTH}) IN (
  SELECT substr(page, 1, length(page) - 1), CASE client WHEN 'desktop' THEN 'desktop' ELSE 'phone' END,
    CAST(strftime(date, '%Y%m') AS INTEGER) FROM ({pages_sql()}) WHERE {lens_sql(lens)})"""
    return f"{a.RUM_RANK} <= {lens.rum_rank}" if lens.rum_rank else "TRUE"


def _rum_histogram_sql(metric: m.RumHistogram, lens: lenses.Lens) -> str:
    if metric.name == "cruxCls":
        bins, edge = a.CLS_BINS, "DECIMAL(38,9)"
    else:
        bins, edge = a.ms_bins(a.RUM_MS.index(metric.path.split(".")[-1])), "BIGINT"
    raw = " UNION ALL ".join(
        f"SELECT {RUM_DATE} AS date, CASE WHEN {a.DEVICE} = 'desktop' THEN 'desktop' ELSE 'mobile' END AS client, "
        f"{s} AS s, {e} AS e, {d} AS d FROM lineitem WHERE NOT ({a.BINS_NULL}) AND NOT ({a.BINS_EMPTY}) AND {_lens_rum_sql(lens)}"
        for s, e, d in bins
    )
    if metric.width is None:
        steps = "SELECT date, client, s AS bin, d FROM raw"
    else:
        bin = f"CAST(s + i * CAST({metric.width} AS {edge}) AS {edge})"
        bin = bin if metric.scale == 1 else f"{bin} / {metric.scale}"
        steps = f"""SELECT date, client, {bin} AS bin, d / w AS d FROM (
  SELECT *, unnest(generate_series(0, CAST(ceil(round(w, 6)) AS BIGINT) - 1)) AS i FROM (
    SELECT *, CAST(least(e, s + CAST({metric.clamp} AS {edge})) - s AS DOUBLE) / {metric.width} AS w FROM raw) WHERE w > 0)"""
    return density_sql(
        f"""WITH raw AS ({raw}), steps AS ({steps}),
counts AS (SELECT date, client, bin, sum(d) AS volume FROM steps GROUP BY ALL)"""
    ).replace("bin, volume,", "bin, round(volume, 6) AS volume,")


# ---------------------------------------------------------------- time series

DATED = "strftime(date, '%Y_%m_%d') AS date, epoch_ms(CAST(date AS TIMESTAMP)) AS timestamp, client"


def _floor_sql(floor: str | None) -> str:
    return f"date >= DATE '{floor}'" if floor else "TRUE"


def _headers_unnested() -> str:
    """Requests with a row id, and their header rows."""
    selects = []
    for i, rows in enumerate(a.HEADERS):
        for name, value in rows or ():
            value = value.replace("'", "''").replace("\n", "' || chr(10) || '")
            selects.append(f"SELECT rid, '{name}' AS name, '{value}' AS value FROM r WHERE hc = {i}")
    return " UNION ALL ".join(selects)


def _series_sql(metric, lens: lenses.Lens) -> str:
    chosen = lens_sql(lens).replace(a.RANK, "rank")
    name = metric.name
    if isinstance(metric, m.Quantiles):
        where = [_floor_sql(metric.floor), "is_root_page", chosen]
        if metric.positive:
            where.append("x > 0")
        if metric.needs_lighthouse:
            where.append(HAS_LIGHTHOUSE)
        offsets = {1001: (101, 251, 501, 751, 901), 1000: (100, 250, 500, 750, 900)}[metric.buckets]
        scaled = [f"q[{i}] / {metric.scale}.0" for i in range(1, 6)]
        if metric.places is not None:
            scaled = [rounded(x, metric.places) for x in scaled]
        columns = ", ".join(f"CAST({x} AS DOUBLE) AS {p}" for x, p in zip(scaled, ("p10", "p25", "p50", "p75", "p90")))
        fractions = ", ".join(f"{k}/{metric.buckets}" for k in offsets)
        return f"""WITH src AS ({pages_sql(f'{fact_sql(metric.fact)} AS x')}),
g AS (SELECT date, client, quantile_disc(CAST(x AS DOUBLE), [{fractions}]) AS q FROM src WHERE {' AND '.join(where)} GROUP BY date, client)
SELECT {DATED}, {columns} FROM g{' WHERE q IS NOT NULL' if metric.drop_empty else ''}"""
    if isinstance(metric, m.PassRate):
        i = a.AUDITS.index(metric.audit)
        present = LIGHTHOUSE_NOT_NULL if metric.allow_empty else HAS_LIGHTHOUSE
        where = [_floor_sql(metric.floor), "is_root_page", chosen, present]
        if metric.only_audited:
            where += [f"{a.score_case(i)} < 6", HAS_LIGHTHOUSE]
        passed = f"{a.score_case(i)} IN (0, 1, 2, 5) AND {HAS_LIGHTHOUSE}"
        return f"""WITH src AS ({pages_sql()})
SELECT {DATED}, {rounded(f'100.0 * count(*) FILTER ({passed}) / count(*)', 2)} AS percent
FROM src WHERE {' AND '.join(where)} GROUP BY src.date, src.client"""
    if isinstance(metric, m.FeatureShare):
        n = len(a.FEATURE_SHARES)
        ids = ", ".join(f"'{x.id}'" for x in a.FEATURE_SHARES)
        names = ", ".join(f"'{x.feature}'" for x in a.FEATURE_SHARES)
        has = f"o_orderkey % 17 <> 0 AND {a.FEATURE_INDEX} < {n}"
        counted = "id IS NOT NULL" if metric.by_id else f"id = '{metric.id}' OR feature = '{metric.feature}'"
        return f"""WITH src AS ({pages_sql()}), named AS (SELECT o_orderkey, ([{ids}])[{a.FEATURE_INDEX} + 1] AS i, ([{names}])[{a.FEATURE_INDEX} + 1] AS n FROM src WHERE {has}),
f AS (SELECT o_orderkey AS k, i AS id, n AS feature FROM named UNION ALL SELECT o_orderkey, NULL, n FROM named WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, i, 'Other' FROM named WHERE o_orderkey % 5 = 0),
j AS (SELECT src.*, f.* FROM src LEFT JOIN f ON f.k = src.o_orderkey AND (f.id = '{metric.id}' OR f.feature = '{metric.feature}')
  WHERE is_root_page AND {_floor_sql(metric.floor)} AND {chosen}),
g AS (SELECT date, client, CAST(sum(CASE WHEN {counted} THEN 1 ELSE 0 END) AS BIGINT) AS num_urls, count(*) AS total FROM j GROUP BY date, client)
SELECT {DATED}, num_urls, {rounded('num_urls / total * 100', 5)} AS percent FROM g"""
    if isinstance(metric, m.PageCount):
        return f"""WITH src AS ({pages_sql()})
SELECT {DATED}, count(*) AS urls FROM src WHERE is_root_page AND {_floor_sql(metric.floor)} AND {chosen} GROUP BY src.date, src.client"""
    if isinstance(metric, m.LazyImages):
        return f"""WITH src AS ({pages_sql()})
SELECT {DATED}, {rounded(f'100.0 * count(DISTINCT CASE WHEN {a.LAZY_CASE} < 2 THEN page END) / count(DISTINCT page)', 2)} AS percent
FROM src WHERE is_root_page AND date > DATE '{metric.after}' AND {chosen} GROUP BY src.date, src.client"""
    if isinstance(metric, m.RequestShare):
        join = "JOIN src USING (date, client, is_root_page, rank, page)"
        if metric.what == "http3":
            line = r"regexp_extract(regexp_extract(u.value, '(.*)', 1), '(.*?)(?:, [^ ]* = .*)?$', 1)"
            hit = f"coalesce(r.version IN ('HTTP/3', 'h3', 'h3-29'), FALSE) OR coalesce({line} LIKE '%h3=%' OR {line} LIKE '%h3-29=%', FALSE)"
            join = "LEFT JOIN u ON u.rid = r.rid AND u.name = 'alt-svc' " + join
        else:
            hit = {"http2": "coalesce(r.version = 'HTTP/2', FALSE)", "https": "starts_with(r.url, 'https')"}[metric.what]
        headers = f", u AS ({_headers_unnested()})" if metric.what == "http3" else ""
        return f"""WITH src AS ({pages_sql()}),
r AS (SELECT row_number() OVER () AS rid, {a.HTTP_VERSION} AS version, {a.URL} AS url, {a.HEADER_CASE} AS hc, src.date, src.client, src.is_root_page, src.rank, src.page
  FROM lineitem JOIN src ON l_orderkey = o_orderkey){headers}
SELECT {DATED}, {rounded(f'100.0 * count(*) FILTER ({hit}) / count(*)', 2)} AS percent
FROM r {join} WHERE is_root_page AND {_floor_sql(metric.floor)} AND {chosen} GROUP BY date, client"""
    raise TypeError(name)


def _rum_series_sql(metric: m.RumShare | m.RumVitals, lens: lenses.Lens) -> str:
    columns = {c: v for n in a.SUMMARY_NAMES for c, v in a.triple(n).items()} | a.P75
    where = [f"{a.DEVICE} IN ('desktop', 'phone')"]
    if lens.technology or lens.rum_rank:
        rank = lens_sql(lens) if lens.technology else f"rank = {lens.rum_rank}"
        where.append(
            f"""({a.ORIGIN}, {a.DEVICE}, {RUM_DATE}) IN (SELECT substr(page, 1, length(page) - 1),
  CASE client WHEN 'mobile' THEN 'phone' ELSE client END, date FROM ({pages_sql()}) WHERE is_root_page AND {rank})"""
        )

    def share(name: str, part: int) -> str:
        g, n, p = a.triple(name)
        return f"coalesce({(g, n, p)[part]} / nullif({g} + {n} + {p}, 0) {'>= 0.75' if part == 0 else '>= 0.25'}, FALSE)"

    if isinstance(metric, m.RumVitals):
        where += [f"{RUM_MONTH} > 201909", f"{a.P75['p75_lcp']} IS NOT NULL", f"{a.P75['p75_cls']} IS NOT NULL"]
        hit = (
            f"(CASE WHEN yyyymm >= 202402 THEN p75_inp IS NULL OR {share('inp', 0)} ELSE p75_fid IS NULL OR {share('fid', 0)} END) "
            f"AND {share('lcp', 0)} AND {share('cls', 0)}"
        )
        whole = "TRUE"
    else:
        if metric.since_month:
            where.append(f"{RUM_MONTH} >= {metric.since_month}")
        g, n, p = metric.triple
        name = g.split("_")[1]
        hit, whole = share(name, 2 if metric.poor else 0), f"{g} + {n} + {p} > 0"
    select = ", ".join(f"{v} AS {c}" for c, v in columns.items())
    return f"""WITH src AS (SELECT {RUM_MONTH} AS yyyymm, {RUM_DATE} AS date, CASE WHEN {a.DEVICE} = 'desktop' THEN 'desktop' ELSE 'mobile' END AS client,
  {a.ORIGIN} AS origin, {select} FROM lineitem WHERE {' AND '.join(where)})
SELECT {DATED}, round(count(DISTINCT CASE WHEN {hit} THEN origin END) / nullif(count(DISTINCT CASE WHEN {whole} THEN origin END), 0) * 100, 8) AS percent
FROM src GROUP BY src.date, src.client"""


def _series_query(name: str, lens: str = lenses.BASE) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        metric = m.SERIES[name]
        long = series.series(a.tables(spark, sf_dir), [metric], [lenses.get(lens)])
        rows = series.shape(long, metric).drop("lens")
        return rows.withColumn("percent", F.round("percent", 8)) if m.is_rum(metric) else rows

    return query


# ---------------------------------------------------------------- registration


def histogram_sql(name: str, lens: str = lenses.BASE) -> str:
    metric = m.HISTOGRAMS[name]
    build = _rum_histogram_sql if m.is_rum(metric) else _histogram_sql
    return build(metric, lenses.get(lens))


def series_sql(name: str, lens: str = lenses.BASE) -> str:
    metric = m.SERIES[name]
    build = _rum_series_sql if m.is_rum(metric) else _series_sql
    return build(metric, lenses.get(lens))


# Reports shown through every lens.
LENS_HISTOGRAMS = {"hist": "bytesTotal", "requests": "evalJs", "rum_hist": "cruxFcp"}
LENS_SERIES = {"series": "bytesTotal", "rum_series": "cruxFastLcp"}


def queries() -> dict[str, tuple[Query, str]]:
    registered = {}
    for name in m.HISTOGRAMS:
        registered[f"hist_{name}"] = (_histogram_query(name), histogram_sql(name))
    for name in m.SERIES:
        registered[f"ts_{name}"] = (_series_query(name), series_sql(name))
    for lens in lenses.LENSES:
        for label, name in LENS_HISTOGRAMS.items():
            registered[f"lens_{lens}_{label}"] = (_histogram_query(name, lens), histogram_sql(name, lens))
        for label, name in LENS_SERIES.items():
            registered[f"lens_{lens}_{label}"] = (_series_query(name, lens), series_sql(name, lens))
    return registered
