"""Registered queries for single operators, straight on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from contract.analogs import read
from contract.reports import DATED, density_sql, rounded
from sitepulse.functions import jsoncols, scalar
from sitepulse.operators import distribution, histogram, joins, kilobytes, timeseries as ts

QUERIES: dict = {}


def register(sql: str | None = None, name: str | None = None):
    def add(query):
        QUERIES[name or query.__name__] = (query, sql)
        return query

    return add


def _hist(df: DataFrame) -> DataFrame:
    return df.withColumns({"pdf": F.round("pdf", 8), "cdf": F.round("cdf", 8)})


def _hist_sql(counts: str, by: str = "client") -> str:
    return density_sql(f"WITH counts AS ({counts})", by)


# ---------------------------------------------------------------- histograms on line items


@register(_hist_sql(
    "SELECT l_returnflag AS client, CAST(floor(l_extendedprice / 10240) * 10 AS BIGINT) AS bin, count(*) AS volume FROM lineitem GROUP BY 1, 2"
))
def histogram_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "client")
    return _hist(histogram.histogram(rows, scalar.bucket(F.col("l_extendedprice"), 10240, 10)))


@register(_hist_sql("SELECT l_linestatus AS client, l_quantity AS bin, count(*) AS volume FROM lineitem GROUP BY 1, 2"))
def histogram_count(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").withColumnRenamed("l_linestatus", "client")
    return _hist(histogram.histogram(rows, F.col("l_quantity")))


@register(_hist_sql(
    "SELECT l_returnflag AS client, CASE WHEN l_quantity >= 5 THEN CAST(floor(l_extendedprice / 10240) * 10 AS BIGINT) END AS bin, count(*) AS volume FROM lineitem GROUP BY 1, 2"
))
def histogram_null_bins(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "client")
    bin = F.when(F.col("l_quantity") >= 5, scalar.bucket(F.col("l_extendedprice"), 10240, 10))
    return _hist(histogram.histogram(rows, bin))


@register(_hist_sql(
    "SELECT l_returnflag AS client, floor((l_extendedprice - 50000) / 1000) AS bin, count(*) AS volume FROM lineitem WHERE l_extendedprice - 50000 > 0 GROUP BY 1, 2"
))
def histogram_positive(spark, sf_dir):
    value = F.col("l_extendedprice") - 50000
    rows = read(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "client").where(value > 0)
    return _hist(histogram.histogram(rows, F.floor(value / 1000).cast("double")))


_HAVING = "CASE WHEN l_linenumber <> 3 THEN CAST(floor((l_extendedprice - 30000) / 1000) AS BIGINT) END"


@register(_hist_sql(f"SELECT l_returnflag AS client, {_HAVING} AS bin, count(*) AS volume FROM lineitem WHERE {_HAVING} >= 0 GROUP BY 1, 2"))
def histogram_having(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "client")
    bin = F.when(F.col("l_linenumber") != 3, scalar.bucket(F.col("l_extendedprice") - 30000, 1000, 1))
    return _hist(histogram.histogram(rows, bin, keep_null=False, minimum=0))


@register(_hist_sql(
    "SELECT event_type AS client, CAST(floor(CAST(json_extract(props, '$.k') AS DOUBLE) / 10) * 10 AS BIGINT) AS bin, count(*) AS volume FROM events GROUP BY 1, 2"
))
def histogram_json(spark, sf_dir):
    rows = read(spark, sf_dir, "events").withColumnRenamed("event_type", "client")
    return _hist(histogram.histogram(rows, scalar.bucket(jsoncols.float64(F.col("props"), "k"), 10, 10)))


_FALLBACK = "coalesce(CASE WHEN l_linenumber = 1 THEN l_extendedprice END, CASE WHEN l_linenumber < 4 THEN l_quantity * 1024 END, CASE WHEN l_linenumber < 6 THEN l_partkey END)"


@register(_hist_sql(
    f"SELECT l_returnflag AS client, CAST(floor({_FALLBACK} / 10240) * 10 AS BIGINT) AS bin, count(*) AS volume FROM lineitem WHERE {_FALLBACK} IS NOT NULL GROUP BY 1, 2"
))
def histogram_fallback(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "client")
    line = F.col("l_linenumber")
    value = F.coalesce(
        F.when(line == 1, F.col("l_extendedprice")),
        F.when(line < 4, F.col("l_quantity") * 1024),
        F.when(line < 6, F.col("l_partkey")),
    )
    return _hist(histogram.histogram(rows, scalar.bucket(value, 10240, 10), keep_null=False))


@register(_hist_sql(
    "SELECT o_orderstatus AS client, CAST(round(l_extendedprice / 20) AS BIGINT) * 20 AS bin, count(*) AS volume FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"
))
def histogram_join_round(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("client"))
    rows = read(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return _hist(histogram.histogram(rows, scalar.round_to_int(F.col("l_extendedprice") / 20) * 20))


# ---------------------------------------------------------------- pre-binned histograms on parts

_PART_BINS = """array(
  named_struct('start', CAST(100 * p_size AS BIGINT), 'end', CAST(100 * p_size + 50 * (p_partkey % 9) AS BIGINT), 'density', p_retailprice / 7),
  named_struct('start', CAST(9000 AS BIGINT), 'end', CAST(90000 AS BIGINT), 'density', CAST(p_size AS DOUBLE) / 11))"""
_PART_RAW = """SELECT p_brand AS client, 100 * p_size AS s, 100 * p_size + 50 * (p_partkey % 9) AS e, p_retailprice / 7 AS d FROM part
  UNION ALL SELECT p_brand, 9000, 90000, p_size / 11 FROM part"""


def _part_volumes(spark, sf_dir):
    parts = read(spark, sf_dir, "part").selectExpr("p_brand AS client", f"{_PART_BINS} AS bins")
    return histogram.bin_volumes(parts, F.col("bins"), ["client"])


@register(density_sql(f"""WITH raw AS ({_PART_RAW}), w AS (SELECT *, (least(e, s + 5000) - s) / 100.0 AS w FROM raw),
steps AS (SELECT client, s, d / CAST(w AS DOUBLE) AS d, unnest(generate_series(0, CAST(ceil(w) AS BIGINT) - 1)) AS i FROM w WHERE w > 0),
counts AS (SELECT client, CAST((s + 100 * i) AS BIGINT) / 1000 AS bin, sum(d) AS volume FROM steps GROUP BY ALL)""", "client").replace("bin, volume,", "bin, round(volume, 5) AS volume,"))
def rum_histogram_spread(spark, sf_dir):
    spread = histogram.spread_volumes(_part_volumes(spark, sf_dir), ["client"], F.lit(100), F.lit(5000))
    seconds = spread.withColumn("bin", F.col("bin") / 1000)
    return _hist(histogram.pdf_cdf(seconds, ["client"])).withColumn("volume", F.round("volume", 5))


@register(density_sql(f"WITH raw AS ({_PART_RAW}), counts AS (SELECT client, CAST(s AS BIGINT) AS bin, sum(d) AS volume FROM raw GROUP BY ALL)", "client").replace("bin, volume,", "bin, round(volume, 5) AS volume,"))
def rum_histogram_raw(spark, sf_dir):
    raw = histogram.raw_volumes(_part_volumes(spark, sf_dir), ["client"])
    return _hist(histogram.pdf_cdf(raw, ["client"])).withColumn("volume", F.round("volume", 5))


# ---------------------------------------------------------------- time series on orders

_MONTHLY = """src AS (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  CASE WHEN o_orderkey % 2 = 1 THEN 'desktop' ELSE 'mobile' END AS client FROM orders)"""


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").withColumns(
        {
            "date": F.trunc(F.col("o_orderdate").cast("date"), "MM"),
            "client": F.when(F.col("o_orderkey") % 2 == 1, "desktop").otherwise("mobile"),
        }
    )


def _quantile_sql(offsets, buckets, scale):
    fractions = ", ".join(f"{k}/{buckets}" for k in offsets)
    columns = ", ".join(
        f"{rounded(f'q[{i}] / {scale}.0', 2)} AS {p}" for i, p in enumerate(ts.QUANTILE_NAMES, 1)
    )
    return f"""WITH {_MONTHLY}, g AS (SELECT date, client, quantile_disc(o_totalprice, [{fractions}]) AS q FROM src GROUP BY date, client)
SELECT {DATED}, {columns} FROM g"""


def _quantile_series(spark, sf_dir, buckets, scale):
    grouped = _monthly(spark, sf_dir).groupBy("date", "client").agg(ts.quantiles(F.col("o_totalprice"), buckets).alias("q"))
    return ts.newest_first(ts.dated(grouped, ts.quantile_columns(F.col("q"), scale)))


@register(_quantile_sql((101, 251, 501, 751, 901), 1001, 1024))
def ts_quantiles_1001(spark, sf_dir):
    return _quantile_series(spark, sf_dir, 1001, 1024)


@register(_quantile_sql((100, 250, 500, 750, 900), 1000, 1))
def ts_quantiles_1000(spark, sf_dir):
    return _quantile_series(spark, sf_dir, 1000, 1)


@register(f"""WITH {_MONTHLY} SELECT {DATED}, {rounded("100.0 * count(*) FILTER (o_orderstatus IN ('F', 'O')) / count(*)", 2)} AS percent
FROM src WHERE o_orderstatus IS NOT NULL GROUP BY src.date, src.client""")
def ts_percent_pass(spark, sf_dir):
    rows = _monthly(spark, sf_dir).where(F.col("o_orderstatus").isNotNull())
    grouped = rows.groupBy("date", "client").agg(
        ts.count_where(F.col("o_orderstatus").isin("F", "O")).alias("passed"), F.count(F.lit(1)).alias("n")
    )
    return ts.newest_first(ts.dated(grouped, [scalar.percent(F.col("passed"), F.col("n")).alias("percent")]))


@register("""WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS date, event_type FROM events),
u AS (SELECT DISTINCT user_id, date, CASE WHEN user_id % 2 = 1 THEN 'desktop' ELSE 'mobile' END AS client FROM d),
j AS (SELECT u.date, u.client, d.event_type FROM u LEFT JOIN d ON d.user_id = u.user_id AND d.date = u.date AND d.event_type IN ('click', 'purchase'))
SELECT strftime(date, '%Y_%m_%d') AS date, epoch_ms(CAST(date AS TIMESTAMP)) AS timestamp, client,
  count(event_type) AS num_urls, round(count(event_type) / count(*) * 100, 5) AS percent FROM j GROUP BY j.date, j.client""")
def ts_feature_share(spark, sf_dir):
    days = (
        read(spark, sf_dir, "events")
        .groupBy("user_id", F.col("ts").cast("date").alias("date"))
        .agg(F.collect_set("event_type").alias("features"))
        .withColumn("client", F.when(F.col("user_id") % 2 == 1, "desktop").otherwise("mobile"))
    )
    used = ts.matches(F.col("features"), lambda f: f.isin("click", "purchase"))
    grouped = days.groupBy("date", "client").agg(
        F.sum(F.size(used)).alias("num_urls"), F.sum(ts.left_unnest_rows(used)).alias("n")
    )
    share = F.round(scalar.safe_divide(F.col("num_urls"), F.col("n")) * 100, 5)
    return ts.newest_first(ts.dated(grouped, ["num_urls", share.alias("percent")]), F.col("num_urls").desc())


@register(f"""WITH {_MONTHLY} SELECT {DATED}, {rounded("100.0 * count(*) FILTER (starts_with(l_linestatus, 'O')) / count(*)", 2)} AS percent
FROM lineitem JOIN src ON l_orderkey = o_orderkey GROUP BY src.date, src.client""")
def ts_request_percent(spark, sf_dir):
    items = (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n"), ts.count_where(F.col("l_linestatus").startswith("O")).alias("hits"))
    )
    joined = items.join(_monthly(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
    grouped = joined.groupBy("date", "client").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    return ts.newest_first(ts.dated(grouped, [scalar.percent(F.col("hits"), F.col("n")).alias("percent")]))


_HEADER = "CASE l_linenumber % 4 WHEN 0 THEN 'h3=\":443\", x = ' || l_returnflag WHEN 1 THEN 'q = 1, y = h3=' WHEN 2 THEN l_returnflag || ', h3-29=\":443\"' END"
_HEADER_LINE = r"regexp_extract(regexp_extract(h, '(.*)', 1), '(.*?)(?:, [^ ]* = .*)?$', 1)"


@register(f"""WITH r AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, l_returnflag AS client, {_HEADER} AS h FROM lineitem)
SELECT {DATED}, {rounded(f"100.0 * count(*) FILTER ({_HEADER_LINE} LIKE '%h3=%' OR {_HEADER_LINE} LIKE '%h3-29=%') / count(*)", 2)} AS percent
FROM r GROUP BY r.date, r.client""")
def ts_header_regex(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").selectExpr(
        "trunc(CAST(l_shipdate AS DATE), 'MM') AS date", "l_returnflag AS client", f"{_HEADER} AS h"
    )
    grouped = rows.groupBy("date", "client").agg(
        ts.count_where(scalar.advertises_http3(F.col("h"))).alias("hits"), F.count(F.lit(1)).alias("n")
    )
    return ts.newest_first(ts.dated(grouped, [scalar.percent(F.col("hits"), F.col("n")).alias("percent")]))


@register(f"""WITH {_MONTHLY} SELECT {DATED},
  {rounded("100.0 * count(DISTINCT CASE WHEN o_totalprice > 250000 THEN o_custkey END) / count(DISTINCT o_custkey)", 2)} AS percent
FROM src GROUP BY src.date, src.client""")
def ts_distinct_percent(spark, sf_dir):
    shares = ts.distinct_shares(
        _monthly(spark, sf_dir), ["date", "client"], "o_custkey", {"hits": F.col("o_totalprice") > 250000}
    )
    return ts.newest_first(ts.dated(shares, [scalar.percent(F.col("hits"), F.col("keys")).alias("percent")]))


@register(f"WITH {_MONTHLY} SELECT {DATED}, count(*) AS urls FROM src WHERE o_orderpriority <> '5-LOW' GROUP BY src.date, src.client")
def ts_count(spark, sf_dir):
    rows = _monthly(spark, sf_dir).where(F.col("o_orderpriority") != "5-LOW")
    return ts.newest_first(ts.dated(rows.groupBy("date", "client").agg(F.count(F.lit(1)).alias("urls")), ["urls"]))


# ---------------------------------------------------------------- unnesting

_WORDS_SQL = "SELECT item_id, unnest(string_split(text, ' ')) AS word FROM benchmark"


@register(f"SELECT item_id, word, count(*) AS n FROM ({_WORDS_SQL}) WHERE word <> '' GROUP BY ALL")
def unnest_inner(spark, sf_dir):
    rows = read(spark, sf_dir, "benchmark").withColumn("words", F.split("text", " "))
    words = joins.unnest(rows, F.filter("words", lambda w: w != ""), "word")
    return words.groupBy("item_id", "word").agg(F.count(F.lit(1)).alias("n"))


@register(f"""WITH w AS ({_WORDS_SQL}) SELECT b.item_id, w.word FROM benchmark b
LEFT JOIN w ON w.item_id = b.item_id AND starts_with(w.word, 'th')""")
def unnest_left(spark, sf_dir):
    rows = read(spark, sf_dir, "benchmark").withColumn("words", F.split("text", " "))
    return joins.left_unnest(rows, F.col("words"), "word", lambda w: w.startswith("th")).select("item_id", "word")


# ---------------------------------------------------------------- exact distributions

_EDA = """w AS (SELECT l_partkey % 5000 AS rank, CAST(trunc(l_extendedprice * 30 / 1024) AS BIGINT) AS "TOTAL",
  CAST(trunc(l_extendedprice / 1024) AS BIGINT) AS "HTML", CAST(trunc(l_quantity * 2000 / 1024) AS BIGINT) AS "JS",
  CAST(trunc(l_extendedprice * l_discount / 1024) AS BIGINT) AS "OTHER1", CAST(trunc(l_quantity * 100 / 1024) AS BIGINT) AS "OTHER2",
  CAST(trunc(l_extendedprice * l_tax / 1024) AS BIGINT) AS "OTHER3" FROM lineitem),
weights AS (SELECT rank, "TOTAL", "HTML", "JS", "OTHER1" + "OTHER2" + "OTHER3" AS "OTHER" FROM w),
long AS (SELECT 'TOTAL' AS metric, "TOTAL" AS value, rank FROM weights UNION ALL SELECT 'HTML', "HTML", rank FROM weights
  UNION ALL SELECT 'JS', "JS", rank FROM weights UNION ALL SELECT 'OTHER', "OTHER", rank FROM weights)"""
_PARTS = ("TOTAL", "HTML", "JS", "OTHER")


def _flat_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a flat page table."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey % 5000 AS rank", "l_extendedprice * 30 AS bytesTotal", "l_extendedprice AS bytesHtml",
        "l_quantity * 2000 AS bytesJS", "l_quantity AS bytesCSS", "l_tax AS bytesImg", "l_tax AS bytesFont",
        "l_tax AS bytesFlash", "l_tax AS bytesJson", "l_extendedprice * l_discount AS bytesOther",
        "l_quantity * 100 AS bytesVideo", "l_extendedprice * l_tax AS bytesAudio",
    )


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kilobytes.kilobytes(_flat_pages(spark, sf_dir))


def _weight_counts(spark, sf_dir, max_rank=None):
    long = kilobytes.long_form(_weights(spark, sf_dir), _PARTS, max_rank)
    return distribution.value_counts(long, F.col("value"), ["metric"])


@register(f'WITH {_EDA} SELECT rank AS "RANK", "TOTAL", "HTML", "JS", "OTHER", count(*) AS n FROM weights GROUP BY ALL')
def eda_kb(spark, sf_dir):
    weights = _weights(spark, sf_dir).select("RANK", *_PARTS)
    return weights.groupBy("RANK", *_PARTS).agg(F.count(F.lit(1)).alias("n"))


@register(f"""WITH {_EDA} SELECT rank AS "RANK", "TOTAL", "HTML", "JS", "OTHER1" AS "OTHER", count(*) AS n FROM w GROUP BY ALL""")
def eda_kb_older(spark, sf_dir):
    """The older page tables, which count neither video nor audio."""
    older = _flat_pages(spark, sf_dir).drop("bytesVideo", "bytesAudio")
    weights = kilobytes.kilobytes(older, with_media=False).select("RANK", *_PARTS)
    return weights.groupBy("RANK", *_PARTS).agg(F.count(F.lit(1)).alias("n"))


@register(f"""WITH {_EDA}, kept AS (SELECT * FROM long WHERE rank < 1000),
c AS (SELECT metric, CAST(trunc(quantile_cont(CAST(value AS DOUBLE), 0.97)) AS BIGINT) AS cut FROM kept GROUP BY metric)
SELECT metric, least(value * 50 // cut, 49) AS bin, least(value * 50 // cut, 49) * cut / 50 AS low,
  (least(value * 50 // cut, 49) + 1) * cut / 50 AS high, count(*) AS n
FROM kept JOIN c USING (metric) WHERE cut > 0 AND value BETWEEN 0 AND cut GROUP BY ALL""")
def eda_hist50(spark, sf_dir):
    hist = distribution.equal_width_histogram(_weight_counts(spark, sf_dir, 1000), ["metric"], trim=0.97)
    return hist.withColumn("bin", F.col("bin").cast("bigint"))


@register(f"""WITH {_EDA} SELECT metric, CAST(trunc(quantile_cont(CAST(value AS DOUBLE), 0.25)) AS BIGINT) AS q1,
  CAST(trunc(quantile_cont(CAST(value AS DOUBLE), 0.5)) AS BIGINT) AS q2, CAST(trunc(quantile_cont(CAST(value AS DOUBLE), 0.75)) AS BIGINT) AS q3,
  CAST(trunc(avg(value)) AS BIGINT) AS mean FROM long GROUP BY metric""")
def eda_quartiles(spark, sf_dir):
    return distribution.quartile_summary(_weight_counts(spark, sf_dir), ["metric"])


_CDF_SQL = """ranked AS (SELECT {by}, value, (row_number() OVER (PARTITION BY {by} ORDER BY value) - 1)
  / greatest(count(*) OVER (PARTITION BY {by}) - 1, 1) AS cdf FROM {source})"""


@register(f"""WITH {_EDA}, {_CDF_SQL.format(by='metric', source='long')},
c AS (SELECT metric, trunc(quantile_cont(CAST(value AS DOUBLE), 0.97)) AS cut FROM long GROUP BY metric)
SELECT metric, value, count(*) AS n, round(min(cdf), 9) AS cdf_first, round(max(cdf), 9) AS cdf_last
FROM ranked JOIN c USING (metric) WHERE value <= cut GROUP BY metric, value""")
def eda_cdf(spark, sf_dir):
    cdf = distribution.empirical_cdf(_weight_counts(spark, sf_dir), ["metric"], trim=0.97)
    return cdf.withColumns({c: F.round(c, 9) for c in ("cdf_first", "cdf_last")})


@register(f"WITH {_EDA}, {_CDF_SQL.format(by='metric', source='long')} SELECT metric, value, round(cdf, 9) AS cdf FROM ranked")
def eda_cdf_points(spark, sf_dir):
    cdf = distribution.empirical_cdf(_weight_counts(spark, sf_dir), ["metric"])
    return distribution.cdf_points(cdf, ["metric"], chunk=256).withColumn("cdf", F.round("cdf", 9))


@register(f"""WITH {_EDA}, both_ AS (SELECT '2014' AS series, rank, value FROM long WHERE metric = 'HTML'
  UNION ALL SELECT '2015', rank, value FROM long WHERE metric = 'JS'),
{_CDF_SQL.format(by='series', source='both_')}
SELECT series, value, count(*) AS n, round(min(cdf), 9) AS cdf_first, round(max(cdf), 9) AS cdf_last FROM ranked GROUP BY series, value""")
def eda_compare(spark, sf_dir):
    weights = _weights(spark, sf_dir)
    both = kilobytes.compare({"2014": weights.select(F.col("HTML").alias("value")), "2015": weights.select(F.col("JS").alias("value"))})
    counts = distribution.value_counts(both, F.col("value"), ["series"])
    return distribution.empirical_cdf(counts, ["series"]).withColumns(
        {c: F.round(c, 9) for c in ("cdf_first", "cdf_last")}
    )


@register(f"""WITH {_EDA} SELECT metric, quantile_disc(value, 101/1001) AS p10, quantile_disc(value, 501/1001) AS p50,
  quantile_disc(value, 901/1001) AS p90 FROM long GROUP BY metric""")
def exact_quantiles(spark, sf_dir):
    wanted = {"p10": 101 / 1001, "p50": 501 / 1001, "p90": 901 / 1001}
    return distribution.exact_quantiles(_weight_counts(spark, sf_dir), wanted, ["metric"], discrete=True)


def queries() -> dict:
    return QUERIES
