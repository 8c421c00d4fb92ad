"""Crawl and real-user tables derived from the given tables.

The test data holds no crawl, so pages come from ``orders``, requests from ``lineitem`` and the
real-user tables from ``lineitem``. Scalar expressions below are valid in Spark SQL and in DuckDB;
Spark packs them into the JSON documents the reports read, the check SQL reads them flat.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sitepulse.plans.facts import AUDITS, SUMMARY_NUMBERS
from sitepulse.plans.metrics import FEATURE_SHARES


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, each: int | None = None) -> DataFrame:
    """A table with fewer splits than cores, dealt out to all of them before documents are built.

    Test tables are single files. A table of many files stays as it is, without a shuffle. With ``each``, a part has
    about that many rows at most, however large the table: for work that is long for a row, such as a file of its own.
    """
    parts = rows.sparkSession.sparkContext.defaultParallelism
    if each is not None:
        parts = max(parts, -(-rows.count() // each))
    return rows if rows.rdd.getNumPartitions() >= parts else rows.repartition(parts)


def _number(k: int, times: int, over: int, plus: str = "") -> str:
    """An even number from the order value, at times NULL or 0."""
    return (
        f"CASE WHEN (o_orderkey + {k}) % 11 = 0 THEN NULL WHEN (o_orderkey + {k}) % 13 = 0 THEN 0 "
        f"ELSE CAST(2 * floor(o_totalprice * {times} / {over}) AS BIGINT){plus} END"
    )


def _some(k: int, gap: int, value: str) -> str:
    return f"CASE WHEN (o_orderkey + {k}) % {gap} <> 0 THEN {value} END"


# Page measures by fact name, as expressions over orders.
SUMMARY = {
    **{name: _number(k, k + 1, 16) for k, name in enumerate(SUMMARY_NUMBERS[:8])},
    **{name: _number(k, 1, 4000 * (k - 6)) for k, name in enumerate(SUMMARY_NUMBERS[8:16], 8)},
    "onLoad": _number(16, 1, 10),
    "onContentLoaded": _number(17, 1, 14),
    "_connections": _number(18, 1, 20000),
}
PAYLOAD = {
    "_SpeedIndex": _number(19, 1, 30, " + 0.5"),
    "_gzip_savings": _number(20, 1, 3),
    "_image_savings": _number(21, 2, 3),
    "_cpu.v8.compile": _number(22, 1, 2000, " - 100"),
    "_chromeUserTiming.firstContentfulPaint": _number(23, 1, 60, " - 600"),
}
BOOTUP = (_some(1, 3, "CAST(2 * floor(o_totalprice / 40) AS BIGINT)"), _some(0, 5, "CAST(2 * floor(o_totalprice / 90) AS BIGINT)"))
INTERACTIVE = (_some(2, 3, "CAST(2 * floor(o_totalprice / 20) AS BIGINT)"), _some(1, 4, "CAST(2 * floor(o_totalprice / 25) AS BIGINT)"))
CONSISTENTLY = _some(3, 5, "CAST(2 * floor(o_totalprice / 35) AS BIGINT)")
OFFSCREEN = (_some(1, 3, "CAST(floor(o_totalprice) AS BIGINT)"), _some(2, 4, "CAST(floor(o_totalprice / 2048) AS BIGINT)"))
UNOPTIMIZED = (_some(2, 3, "CAST(floor(o_totalprice * 2) AS BIGINT)"), _some(0, 4, "CAST(floor(o_totalprice / 1024) AS BIGINT)"))
A11Y = (_some(0, 3, "(o_orderkey % 101) / 100"), _some(1, 2, "CAST(o_orderkey % 97 AS DOUBLE)"))
# Audit scores come in many JSON types: true, 1, "1", 0, false, 1.0 or missing.
SCORE_TEXTS = ("true", "1", '"1"', "0", "false", "1.0")


def score_case(i: int) -> str:
    return f"(o_orderkey + o_custkey + {i}) % 7"


LIGHTHOUSE_CASE = "o_orderkey % 20"  # 0: NULL, 1: the empty object
LAZY_CASE = "o_orderkey % 6"
TECH_CASE = "o_custkey % 6"
TECHNOLOGIES = (("WordPress", "PHP"), ("Drupal",), ("Magento", "PHP"), (), None, ("Drupal", "WordPress"))
FEATURE_INDEX = f"(o_orderkey % {len(FEATURE_SHARES) + 2})"
RANK = (
    "CASE WHEN o_custkey % 10 = 0 THEN 1000 WHEN o_custkey % 10 <= 2 THEN 10000 "
    "WHEN o_custkey % 10 <= 5 THEN 100000 WHEN o_custkey % 10 <= 8 THEN 1000000 END"
)
CLIENT = "CASE WHEN o_orderkey % 2 = 1 THEN 'desktop' ELSE 'mobile' END"
IS_ROOT = "o_orderpriority <> '5-LOW'"
PAGE = "'https://site' || o_custkey || '.example/'"

PAGE_KEYS_SPARK = f"""
  add_months(trunc(CAST(o_orderdate AS DATE), 'MM'), 252) AS date, {CLIENT} AS client,
  {IS_ROOT} AS is_root_page, {PAGE} AS page, CAST({RANK} AS BIGINT) AS rank"""

HTTP_VERSION = (
    "CASE l_linenumber % 5 WHEN 0 THEN 'HTTP/2' WHEN 1 THEN 'HTTP/3' WHEN 2 THEN 'h3' "
    "WHEN 3 THEN 'http/1.1' END"
)
URL = (
    "CASE WHEN l_discount >= 0.02 THEN 'https' ELSE 'http' END || '://cdn' || l_suppkey || "
    "'.example/r' || l_linenumber"
)
SCRIPT_MS = "CASE WHEN l_linenumber = 4 THEN NULL ELSE floor(l_extendedprice / 100) - 50 END"
HEADER_CASE = "CAST(l_quantity AS INT) % 6"
# Header lists by case; case 4 is NULL.
HEADERS = (
    (("alt-svc", 'h3=":443"; ma=86400'),),
    (("alt-svc", 'h3-29=":443"'), ("alt-svc", "clear")),
    (("alt-svc", 'quic=":443", more = h3=":443"'),),
    (),
    None,
    (("server", 'h3=":443"'), ("alt-svc", 'clear\nh3=":443"')),
)

DEVICE = "CASE l_returnflag WHEN 'A' THEN 'desktop' WHEN 'N' THEN 'phone' ELSE 'tablet' END"
ORIGIN = "'https://site' || l_suppkey || '.example'"
RUM_RANK = (
    "CASE l_suppkey % 4 WHEN 0 THEN 1000 WHEN 1 THEN 10000 WHEN 2 THEN 100000 ELSE 1000000 END"
)
RUM_MS = (
    "dom_content_loaded", "first_contentful_paint", "first_paint", "interaction_to_next_paint",
    "largest_contentful_paint", "onload", "time_to_first_byte",
)


def ms_bins(k: int) -> tuple[tuple[str, str, str], ...]:
    """Given bins of one paint metric: start, end, density.

    Odd divisors keep the shares off binary fractions, whose rounding is a matter of taste.
    """
    start = f"CAST(100 * floor(l_quantity) + {k} AS BIGINT)"
    return (
        (start, f"{start} + 100 * (l_linenumber % 4) + {50 * (k % 2) + 50}", "l_discount / 7"),
        ("CAST(0 AS BIGINT)", "CAST(1000 AS BIGINT)", "l_tax / 11"),
        ("CAST(20000 AS BIGINT)", "CAST(60000 AS BIGINT)", "(l_quantity + CAST(0.3 AS DOUBLE)) / 13"),
    )


CLS_BINS = (
    ("CAST(l_discount AS DECIMAL(38,9))", "CAST(l_discount + 0.05 * (1 + l_linenumber % 3) AS DECIMAL(38,9))", "l_tax / 11"),
    ("CAST(1 AS DECIMAL(38,9))", "CAST(CASE WHEN l_quantity > 45 THEN 20 ELSE 1.25 END AS DECIMAL(38,9))", "(l_quantity + CAST(0.7 AS DOUBLE)) / 17"),
)
# NULL and empty bin arrays.
BINS_NULL, BINS_EMPTY = "l_linenumber = 5", "l_linenumber = 6"

SUMMARY_NAMES = ("dcl", "fcp", "fp", "ol", "ttfb", "lcp", "inp", "fid", "cls")
P75 = {
    "p75_lcp": "CASE WHEN l_linenumber <> 2 THEN l_quantity END",
    "p75_cls": "CASE WHEN l_quantity >= 5 THEN l_quantity END",
    "p75_inp": "CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity END",
    "p75_fid": "CASE WHEN l_linenumber % 4 <> 0 THEN l_quantity END",
}


def triple(name: str) -> dict[str, str]:
    """The three shares of one measure; all zero on some rows."""
    k = SUMMARY_NAMES.index(name)
    columns = (
        ("small_cls", "medium_cls", "large_cls") if name == "cls" else (f"fast_{name}", f"avg_{name}", f"slow_{name}")
    )
    values = (f"floor(l_quantity) + {k}", f"l_linenumber * {k % 3 + 1}", f"floor(l_discount * {100 + 40 * k})")
    return {
        column: f"CAST(CASE WHEN l_linenumber = 7 THEN 0 ELSE {value} END AS DOUBLE)"
        for column, value in zip(columns, values)
    }


def _fields(values: dict[str, str]) -> str:
    return ", ".join(f"'{name}', {value}" for name, value in values.items())


def _quoted(text: str | None) -> str:
    return "CAST(NULL AS STRING)" if text is None else "'" + text.replace("\n", "\\n") + "'"


def crawl_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw crawl pages with their JSON documents."""
    scores = {
        audit: "named_struct('score', CASE "
        + score_case(i)
        + "".join(f" WHEN {j} THEN parse_json('{text}')" for j, text in enumerate(SCORE_TEXTS))
        + " END)"
        for i, audit in enumerate(AUDITS)
    }

    def savings(pair: tuple[str, str]) -> str:
        return (
            f"named_struct('details', named_struct('overallSavingsBytes', {pair[0]}), 'extendedInfo', "
            f"named_struct('value', named_struct('wastedKb', {pair[1]})))"
        )

    audits = {
        "bootup-time": f"named_struct('numericValue', {BOOTUP[0]}, 'rawValue', {BOOTUP[1]})",
        "interactive": f"named_struct('numericValue', {INTERACTIVE[0]}, 'rawValue', {INTERACTIVE[1]})",
        "consistently-interactive": f"named_struct('rawValue', {CONSISTENTLY})",
        "offscreen-images": savings(OFFSCREEN),
        "uses-optimized-images": savings(UNOPTIMIZED),
        **scores,
    }
    report = (
        f"named_struct('audits', named_struct({_fields(audits)}), "
        f"'categories', named_struct('accessibility', named_struct('score', {A11Y[0]})), "
        f"'reportCategories', array(named_struct('name', 'Performance', 'score', CAST(50 AS DOUBLE)), "
        f"named_struct('name', 'Accessibility', 'score', {A11Y[1]})))"
    )
    technologies = "".join(
        f" WHEN {i} THEN "
        + (
            "CAST(NULL AS ARRAY<STRUCT<technology: STRING>>)"
            if names is None
            else f"CAST(array({', '.join(f'''named_struct('technology', '{n}')''' for n in names)}) AS ARRAY<STRUCT<technology: STRING>>)"
        )
        for i, names in enumerate(TECHNOLOGIES)
    )
    ids = ", ".join(f"'{x.id}'" for x in FEATURE_SHARES)
    names = ", ".join(f"'{x.feature}'" for x in FEATURE_SHARES)
    at = f"CAST({FEATURE_INDEX} + 1 AS INT)"
    features = f"""array_compact(array(
      CASE WHEN {FEATURE_INDEX} < {len(FEATURE_SHARES)} THEN
        named_struct('id', try_element_at(array({ids}), {at}), 'feature', try_element_at(array({names}), {at})) END,
      CASE WHEN o_orderkey % 3 = 0 AND {FEATURE_INDEX} < {len(FEATURE_SHARES)} THEN
        named_struct('id', CAST(NULL AS STRING), 'feature', try_element_at(array({names}), {at})) END,
      CASE WHEN o_orderkey % 5 = 0 AND {FEATURE_INDEX} < {len(FEATURE_SHARES)} THEN
        named_struct('id', try_element_at(array({ids}), {at}), 'feature', 'Other') END))"""
    return dealt(read(spark, sf_dir, "orders")).selectExpr(
        *_split_select(PAGE_KEYS_SPARK),
        f"to_json(named_struct({_fields(SUMMARY)})) AS summary",
        f"to_json(named_struct({_fields(PAYLOAD)})) AS payload",
        f"CASE {LIGHTHOUSE_CASE} WHEN 0 THEN NULL WHEN 1 THEN '{{}}' ELSE to_json({report}) END AS lighthouse",
        f"""named_struct('other', CASE {LAZY_CASE} WHEN 0 THEN '{{"img-loading-attr":["eager","LAZY"]}}'
            WHEN 1 THEN '{{"img-loading-attr":["lazy"]}}' WHEN 2 THEN '{{"img-loading-attr":[]}}'
            WHEN 3 THEN '{{"img-loading-attr":["auto",null]}}' WHEN 4 THEN '{{}}' END) AS custom_metrics""",
        f"CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE {features} END AS features",
        f"CASE {TECH_CASE}{technologies} END AS technologies",
    )


def _split_select(text: str) -> list[str]:
    """Split a select list on commas outside parentheses."""
    parts, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            parts.append(text[start:i].strip())
            start = i + 1
    return [*parts, text[start:].strip()]


def crawl_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw crawl requests: one per line item, on the page of its order."""
    orders = read(spark, sf_dir, "orders").selectExpr("o_orderkey", *_split_select(PAGE_KEYS_SPARK))
    dtype = "ARRAY<STRUCT<name: STRING, value: STRING>>"
    headers = "".join(
        f" WHEN {i} THEN "
        + (
            f"CAST(NULL AS {dtype})"
            if rows is None
            else "CAST(array("
            + ", ".join(f"named_struct('name', '{n}', 'value', {_quoted(v)})" for n, v in rows)
            + f") AS {dtype})"
        )
        for i, rows in enumerate(HEADERS)
    )
    items = dealt(read(spark, sf_dir, "lineitem")).selectExpr(
        "l_orderkey",
        f"{URL} AS url",
        f"to_json(named_struct('respHttpVersion', {HTTP_VERSION})) AS summary",
        f"to_json(named_struct('_cpu.EvaluateScript', {SCRIPT_MS})) AS payload",
        f"CASE {HEADER_CASE}{headers} END AS response_headers",
    )
    return items.join(orders, items.l_orderkey == orders.o_orderkey).drop("l_orderkey", "o_orderkey")


def _bins(rows: tuple[tuple[str, str, str], ...], edge: str) -> str:
    dtype = f"ARRAY<STRUCT<start: {edge}, end: {edge}, density: DOUBLE>>"
    built = ", ".join(f"named_struct('start', {s}, 'end', {e}, 'density', {d})" for s, e, d in rows)
    return (
        f"named_struct('histogram', named_struct('bin', CASE WHEN {BINS_NULL} THEN NULL "
        f"WHEN {BINS_EMPTY} THEN CAST(array() AS {dtype}) ELSE CAST(array({built}) AS {dtype}) END))"
    )


def rum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pre-binned real-user table."""
    by_name = {name: _bins(ms_bins(k), "BIGINT") for k, name in enumerate(RUM_MS)}
    ttfb = by_name.pop("time_to_first_byte")
    return dealt(read(spark, sf_dir, "lineitem")).selectExpr(
        "CAST(date_format(add_months(l_shipdate, 276), 'yyyyMM') AS INT) AS yyyymm",
        f"{ORIGIN} AS origin",
        f"named_struct('name', {DEVICE}) AS form_factor",
        *[f"{value} AS {name}" for name, value in by_name.items()],
        f"named_struct('cumulative_layout_shift', {_bins(CLS_BINS, 'DECIMAL(38,9)')}) AS layout_instability",
        f"named_struct('popularity', named_struct('rank', CAST({RUM_RANK} AS BIGINT)), "
        f"'time_to_first_byte', {ttfb}) AS experimental",
    )


def rum_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The real-user device summary."""
    shares = {column: value for name in SUMMARY_NAMES for column, value in triple(name).items()}
    return dealt(read(spark, sf_dir, "lineitem")).selectExpr(
        "CAST(date_format(add_months(l_shipdate, 276), 'yyyyMM') AS INT) AS yyyymm",
        "trunc(add_months(l_shipdate, 276), 'MM') AS date",
        f"{DEVICE} AS device",
        f"{ORIGIN} AS origin",
        *[f"{value} AS {column}" for column, value in {**shares, **P75}.items()],
    )


class DerivedTables:
    """The four tables, each derived when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._source = (spark, sf_dir)

    @cached_property
    def pages(self) -> DataFrame:
        return crawl_pages(*self._source)

    @cached_property
    def requests(self) -> DataFrame:
        return crawl_requests(*self._source)

    @cached_property
    def rum(self) -> DataFrame:
        return rum(*self._source)

    @cached_property
    def rum_summary(self) -> DataFrame:
        return rum_summary(*self._source)


def tables(spark: SparkSession, sf_dir: str) -> DerivedTables:
    return DerivedTables(spark, sf_dir)
