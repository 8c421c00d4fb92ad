"""Registered queries for imports, sinks, joins to listings, classification and report runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from contract import analogs, reports as report_queries
from contract.analogs import read
from sitepulse.functions import scalar, text, weburl
from sitepulse.operators import classify, directory
from sitepulse.plans import facts, histograms, lens as lenses, metrics as m, reports, series
from sitepulse.plans.tables import CrawlTables
from sitepulse.session import scratch_path
from sitepulse.sources import csvdump, har, listings, release
from sitepulse.streaming import ingest

QUERIES: dict = {}


def register(sql: str | None = None):
    def add(query):
        QUERIES[query.__name__] = (query, sql)
        return query

    return add


# ---------------------------------------------------------------- HAR documents from web pages

# One HAR per web page: the page itself, a style sheet without text, an empty script, and an entry
# without a response. Metadata by page: missing, home page, deeper page, another tested URL, empty.
_CASE = "page_id % 5"


def _object(*members: str) -> str:
    """A JSON object as a variant, so entries with different members fit one array."""
    return f"parse_json(to_json(named_struct({', '.join(members)})))"


_ENTRIES = (
    _object(
        "'_full_url', url", "'_request_id', 'r' || page_id",
        "'response', named_struct('content', named_struct('text', html, 'size', length(html)))",
    ),
    _object("'_full_url', url || 'a.css'", "'response', named_struct('content', named_struct('size', 0))"),
    _object("'url', url || 'b.js'", "'_id', 'i' || page_id", "'response', named_struct('content', named_struct('text', ''))"),
    _object("'_full_url', url || 'c.png'"),
)
_HAR = f"""to_json(named_struct(
  'log', named_struct(
    'pages', array(named_struct('_URL', url, '_metadata', CASE {_CASE}
        WHEN 1 THEN named_struct('tested_url', CAST(NULL AS STRING), 'crawl_depth', '0')
        WHEN 2 THEN named_struct('tested_url', CAST(NULL AS STRING), 'crawl_depth', '1')
        WHEN 3 THEN named_struct('tested_url', url || '#tested', 'crawl_depth', CAST(NULL AS STRING))
        WHEN 4 THEN named_struct('tested_url', CAST(NULL AS STRING), 'crawl_depth', '') END,
      'id', page_id,
      '_detected', map('CMS', 'WordPress 5.' || page_id % 7 || ',Foo', 'Lang', CASE WHEN page_id % 2 = 0 THEN 'PHP' ELSE 'PHP 8' END),
      '_detected_apps', map('WordPress', '5.1,5.2', 'PHP', CASE WHEN page_id % 3 = 0 THEN '' ELSE ',8' END))),
    'entries', array({', '.join(_ENTRIES)})),
  '_lighthouse', CASE WHEN page_id % 3 <> 0 THEN named_struct('audits', named_struct(
      'screenshot-thumbnails', named_struct('details', named_struct('items', array(html), 'kind', 'x')), 'n', page_id)) END))"""
_RELEASE = "CASE WHEN page_id % 2 = 0 THEN 'chrome' ELSE 'android' END || '-Mar_' || (1 + page_id % 28) || '_2020'"


def hars(spark: SparkSession, sf_dir: str, each: int | None = None) -> DataFrame:
    """HAR documents, one per web page, in release folders of two clients; about ``each`` a task at most."""
    return analogs.dealt(read(spark, sf_dir, "pages"), each).selectExpr(f"{_HAR} AS doc", f"'/crawls/' || {_RELEASE} || '/x.har' AS path")


_HOME = f"{_CASE} <> 2"
_PAGE_URL = f"CASE WHEN {_CASE} = 3 THEN url || '#tested' ELSE url END"
# A limit some pages exceed, so that cutting and skipping show.
_SMALL = har.HarOptions(max_size=1500)
_CUT = 1500


@register(f"SELECT {_PAGE_URL} AS url, page_id AS id, url AS own_url FROM pages WHERE {_HOME}")
def har_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = har.tables(hars(spark, sf_dir))["pages"]
    return pages.select(
        "url",
        F.get_json_object("payload", "$.id").cast("bigint").alias("id"),
        F.get_json_object("payload", "$._URL").alias("own_url"),
    )


@register(f"""SELECT {_PAGE_URL} AS page, url, 'r' || page_id AS request_id, length(html) AS size, FALSE AS has_text FROM pages WHERE {_HOME}
UNION ALL SELECT {_PAGE_URL}, url || 'a.css', NULL, 0, FALSE FROM pages WHERE {_HOME}
UNION ALL SELECT {_PAGE_URL}, NULL, NULL, NULL, FALSE FROM pages WHERE {_HOME}""")
def har_requests(spark, sf_dir):
    requests = har.tables(hars(spark, sf_dir))["requests"]
    return requests.select(
        "page",
        "url",
        F.get_json_object("payload", "$._request_id").alias("request_id"),
        F.get_json_object("payload", "$.response.content.size").cast("bigint").alias("size"),
        F.get_json_object("payload", "$.response.content.text").isNotNull().alias("has_text"),
    )


@register(f"""SELECT {_PAGE_URL} AS page, url, md5(substr(html, 1, {_CUT})) AS body_md5, length(html) > {_CUT} AS truncated FROM pages WHERE {_HOME}
UNION ALL SELECT {_PAGE_URL}, NULL, md5(''), FALSE FROM pages WHERE {_HOME}""")
def har_bodies(spark, sf_dir):
    bodies = har.tables(hars(spark, sf_dir), _SMALL)["response_bodies"]
    return bodies.select("page", "url", F.md5(F.col("body").cast("binary")).alias("body_md5"), "truncated")


@register(f"""SELECT {_PAGE_URL} AS url, page_id AS n, FALSE AS has_items, 'x' AS kind FROM pages WHERE {_HOME} AND page_id % 3 <> 0""")
def har_lighthouse(spark, sf_dir):
    reports_ = har.tables(hars(spark, sf_dir))["lighthouse"]
    details = "$.audits['screenshot-thumbnails'].details"
    return reports_.select(
        "url",
        F.get_json_object("report", "$.audits.n").cast("bigint").alias("n"),
        F.get_json_object("report", f"{details}.items").isNotNull().alias("has_items"),
        F.get_json_object("report", f"{details}.kind").alias("kind"),
    )


@register(f"""WITH ids AS (
  SELECT url, page_id, 'CMS' AS category, 'WordPress 5.' || page_id % 7 AS id FROM pages WHERE {_HOME}
  UNION ALL SELECT url, page_id, 'CMS', 'Foo' FROM pages WHERE {_HOME}
  UNION ALL SELECT url, page_id, 'Lang', CASE WHEN page_id % 2 = 0 THEN 'PHP' ELSE 'PHP 8' END FROM pages WHERE {_HOME})
SELECT url, category, CASE WHEN id IN ('WordPress 5.1', 'WordPress 5.2') THEN 'WordPress'
    WHEN id = 'PHP 8' AND page_id % 3 <> 0 THEN 'PHP' ELSE id END AS app,
  CASE WHEN id IN ('WordPress 5.1', 'WordPress 5.2') THEN substr(id, 11) WHEN id = 'PHP 8' AND page_id % 3 <> 0 THEN '8' ELSE '' END AS info
FROM ids""")
def har_technologies(spark, sf_dir):
    return har.tables(hars(spark, sf_dir))["technologies"]


_RELEASE_COLUMNS = """make_date(2020, 3, CAST(1 + page_id % 28 AS INTEGER)) AS date,
  CASE WHEN page_id % 2 = 0 THEN 'desktop' ELSE 'mobile' END AS client"""
_IMPORTED = f"""WITH p AS (SELECT *, {_RELEASE_COLUMNS} FROM pages WHERE {_HOME})
SELECT 'pages' AS "table", date, client, count(*) AS n FROM p GROUP BY ALL UNION ALL SELECT 'requests', date, client, 3 * count(*) FROM p GROUP BY ALL
UNION ALL SELECT 'response_bodies', date, client, 2 * count(*) FROM p GROUP BY ALL UNION ALL SELECT 'technologies', date, client, 3 * count(*) FROM p GROUP BY ALL
UNION ALL SELECT 'lighthouse', date, client, count(*) FROM p WHERE page_id % 3 <> 0 GROUP BY ALL"""


def _imported(rows: DataFrame) -> DataFrame:
    return rows.groupBy("table", "date", "client").agg(F.count(F.lit(1)).alias("n"))


@register(_IMPORTED)
def har_import(spark, sf_dir):
    """All five tables written in one pass and read back."""
    target = scratch_path(spark, "har-import")
    har.write_tables(har.with_release(hars(spark, sf_dir)), target)
    return _imported(spark.read.parquet(target))


# Files a task writes, so that the longest task does not grow with the table.
_FILES = 1000


def _written_each(docs: DataFrame, folder: str) -> str:
    """Every document in a gzip file of its own, a folder for each task; returns the glob that finds them.

    For every file in a local folder Hadoop starts two processes to set permissions, which take longer than all else; tasks
    write such files themselves. A task's folder appears whole, so that a repeated task adds nothing.
    """
    spark = docs.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    local = target.getPath()

    def write(batches):
        import gzip
        import os

        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        part = f"part-{task.partitionId():05d}"
        attempt = f"{local}-attempts/{part}-{task.taskAttemptId()}"
        os.makedirs(attempt)
        written = 0
        for batch in batches:
            for doc in batch.column(0):
                with open(f"{attempt}/{written:06d}.txt.gz", "wb") as file:
                    file.write(gzip.compress((doc.as_py() or b"") + b"\n", 6))
                written += 1
        os.makedirs(local, exist_ok=True)
        try:
            os.rename(attempt, f"{local}/{part}")
        except OSError:
            if not os.path.isdir(f"{local}/{part}"):
                raise
        yield pa.RecordBatch.from_pydict({"n": [written]})

    rows = docs.select(F.col("doc").cast("binary"))
    if target.getScheme() != "file" or not rows.mapInArrow(write, "n long").agg(F.sum("n")).first()[0]:
        docs.write.option("compression", "gzip").option("maxRecordsPerFile", 1).text(f"{folder}/part")
    return f"{folder}/*/*.gz"


@register(f"SELECT {_PAGE_URL} AS url, page_id AS id FROM pages WHERE {_HOME}")
def har_whole_files(spark, sf_dir):
    """One gzip file per document, read whole by a glob."""
    docs = hars(spark, sf_dir, _FILES).select("doc")
    glob = _written_each(docs, scratch_path(spark, "har-files"))
    pages = har.tables(har.read_files(spark, glob, partitions=8))["pages"]
    return pages.select("url", F.get_json_object("payload", "$.id").cast("bigint").alias("id"))


@register(f"""SELECT 2 * count(*) AS with_body, count(*) FILTER (length(html) > {_CUT}) AS truncated_body, CAST(0 AS BIGINT) AS skipped_pages,
  CAST(0 AS BIGINT) AS skipped_requests, CAST(0 AS BIGINT) AS skipped_lighthouse, CAST(0 AS BIGINT) AS rejected FROM pages WHERE {_HOME}""")
def etl_counters(spark, sf_dir):
    return har.counters(har.fan_out(har.parse(hars(spark, sf_dir)), options=_SMALL))


# A page with a note of its size, so that a limit divides the pages; audits grow with the page number.
_NOTED = 1000
_NOTE = "repeat('n', CAST(page_id % 3 AS INTEGER) * 600)"


@register(f"""WITH p AS (SELECT *, page_id % 3 = 2 AS over FROM pages WHERE {_HOME} AND page_id % 10 <> 7)
SELECT CAST(count(*) FILTER (NOT over) AS BIGINT) AS with_body, CAST(count(*) FILTER (NOT over AND length(html) > {_NOTED}) AS BIGINT) AS truncated_body,
  CAST(count(*) FILTER (over) AS BIGINT) AS skipped_pages, CAST(count(*) FILTER (NOT over AND page_id % 4 = 1) AS BIGINT) AS skipped_requests,
  CAST(count(*) FILTER (NOT over AND page_id % 4 = 3) AS BIGINT) AS skipped_lighthouse,
  (SELECT count(*) FROM pages WHERE page_id % 10 = 7) AS rejected FROM p""")
def etl_counters_limited(spark, sf_dir):
    """Counters of an import whose limit some pages, requests and audits exceed, with broken documents."""
    return har.counters(har.fan_out(har.parse(noted_hars(spark, sf_dir)), options=har.HarOptions(max_size=_NOTED)))


def noted_hars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small documents with one entry, parts of which exceed a limit by the page's number; every tenth is cut off."""
    doc = f"""to_json(named_struct('log', named_struct('pages', array(named_struct('_URL', url, 'note', {_NOTE}, '_metadata',
        named_struct('tested_url', CASE WHEN {_CASE} = 3 THEN url || '#tested' END, 'crawl_depth', CASE WHEN {_CASE} = 2 THEN '1' ELSE '0' END))),
      'entries', array(named_struct('_full_url', url, '_request_id', 'r' || page_id, 'pad', repeat('p', CASE WHEN page_id % 4 = 1 THEN 2000 ELSE 1 END),
        'response', named_struct('content', named_struct('text', html))))),
    '_lighthouse', named_struct('audits', repeat('a', CASE WHEN page_id % 4 = 3 THEN 2000 ELSE 1 END))))"""
    docs = analogs.dealt(read(spark, sf_dir, "pages")).selectExpr("page_id", f"{doc} AS doc", f"'/crawls/' || {_RELEASE} || '/x.har' AS path")
    return docs.withColumn("doc", F.expr("CASE WHEN page_id % 10 = 7 THEN substring(doc, 1, 30) ELSE doc END")).drop("page_id")


_REJECTED = "page_id % 10 = 7"


@register(f"""WITH d AS (SELECT page_id, {_RELEASE_COLUMNS}, html, {_REJECTED} AS bad, {_HOME} AND page_id % 3 = 2 AS over, {_HOME} AS home FROM pages),
good AS (SELECT * FROM d WHERE home AND NOT bad AND NOT over)
SELECT 'rejects' AS "table", 'unparsable' AS info, date, client, count(*) AS n FROM d WHERE bad GROUP BY ALL
UNION ALL SELECT 'oversize', 'pages', date, client, count(*) FROM d WHERE over AND NOT bad GROUP BY ALL
UNION ALL SELECT 'oversize', 'requests', date, client, count(*) FROM good WHERE page_id % 4 = 1 GROUP BY ALL
UNION ALL SELECT 'oversize', 'lighthouse', date, client, count(*) FROM good WHERE page_id % 4 = 3 GROUP BY ALL
UNION ALL SELECT 'oversize', 'response_bodies', date, client, count(*) FROM good WHERE length(html) > {_NOTED} GROUP BY ALL
UNION ALL SELECT 'pages', NULL, date, client, count(*) FROM good GROUP BY ALL
UNION ALL SELECT 'requests', NULL, date, client, count(*) FROM good WHERE page_id % 4 <> 1 GROUP BY ALL
UNION ALL SELECT 'lighthouse', NULL, date, client, count(*) FROM good WHERE page_id % 4 <> 3 GROUP BY ALL
UNION ALL SELECT 'response_bodies', NULL, date, client, count(*) FROM good GROUP BY ALL""")
def har_import_rejects(spark, sf_dir):
    """A limited import of partly broken documents: everything is in some table."""
    target = scratch_path(spark, "har-rejects")
    har.write_tables(har.with_release(noted_hars(spark, sf_dir)), target, har.HarOptions(max_size=_NOTED))
    return spark.read.parquet(target).groupBy("table", "info", "date", "client").agg(F.count(F.lit(1)).alias("n"))


_BIG = 21_000_000


def large_hars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HAR documents; the body of the first home page has 21 million characters."""
    pages = read(spark, sf_dir, "pages")
    first = pages.where(_HOME).agg(F.min("page_id").alias("first"))
    marked = pages.join(F.broadcast(first)).withColumn("html", F.expr("CASE WHEN page_id = first THEN '@large@' ELSE html END"))
    docs = analogs.dealt(marked).selectExpr(f"{_HAR} AS doc", "url", "page_id = first AS large", f"'/crawls/' || {_RELEASE} || '/x.har' AS path")
    # The digits hang on the row, so that no plan holds them as a constant; only the marked document gets them.
    large = F.expr(f"CASE WHEN large THEN replace(doc, '@large@', repeat(concat('0123456789', left(url, 0)), {_BIG} div 10)) ELSE doc END")
    return docs.select(large.alias("doc"), "path")


@register(f"""WITH p AS (SELECT *, page_id = (SELECT min(page_id) FROM pages WHERE {_HOME}) AS big FROM pages WHERE {_HOME})
SELECT {_PAGE_URL} AS page, url, md5(CASE WHEN big THEN repeat('0123456789', {_BIG} // 10) ELSE html END) AS body_md5 FROM p
UNION ALL SELECT {_PAGE_URL}, NULL, md5('') FROM p""")
def har_large_body(spark, sf_dir):
    """One body of 21 million characters among ordinary ones: every row is there, to the byte."""
    docs = large_hars(spark, sf_dir)
    bodies = har.tables(docs)["response_bodies"]
    return bodies.select("page", "url", F.md5(F.col("body").cast("binary")).alias("body_md5"))


@register(f"""SELECT {_PAGE_URL} AS page, url, length(html) > {_BIG} AS truncated, 'r' || page_id AS request_id FROM pages WHERE {_HOME}
UNION ALL SELECT {_PAGE_URL}, url || 'b.js', FALSE, 'i' || page_id FROM pages WHERE {_HOME}""")
def har_legacy_bodies(spark, sf_dir):
    """The older import: limits in bytes, and a request without a full URL takes its short one."""
    return har.tables(hars(spark, sf_dir), har.LEGACY)["response_bodies"].select("page", "url", "truncated", "request_id")


@register("""SELECT CASE WHEN page_id % 4 = 0 THEN 'unparsable' ELSE 'no page' END AS reason, count(*) AS n
FROM pages WHERE page_id % 4 < 2 GROUP BY ALL""")
def har_rejects(spark, sf_dir):
    """Cut documents and documents without pages are set aside with a reason."""
    broken = hars(spark, sf_dir).withColumn("id", F.get_json_object("doc", "$.log.pages[0].id").cast("bigint") % 4)
    doc = (
        F.when(F.col("id") == 0, F.substring("doc", 1, 40))
        .when(F.col("id") == 1, F.lit('{"log":{"pages":[],"entries":[]}}'))
        .otherwise(F.col("doc"))
    )
    return har.rejects(broken.withColumn("doc", doc)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register(_IMPORTED)
def incremental_ingest(spark, sf_dir):
    """Two drops of files, one run after each, and a third run that finds nothing new."""
    source, target, checkpoint = (scratch_path(spark, f"ingest-{n}") for n in ("source", "target", "checkpoint"))
    docs = hars(spark, sf_dir).withColumn("release", release.release_of_path(F.col("path")))
    for client in ("chrome", "android"):
        drop = docs.where(F.col("release").startswith(client)).select("doc", "release")
        drop.write.mode("append").partitionBy("release").text(source)
        ingest.ingest_hars(spark, source, target, checkpoint)
    ingest.ingest_hars(spark, source, target, checkpoint)
    return _imported(spark.read.parquet(target))


@register(f"SELECT 2 * count(*) AS with_body, CAST(0 AS BIGINT) AS rejected, 3 AS runs, CAST(2 * count(*) AS BIGINT) AS bodies FROM pages WHERE {_HOME}")
def incremental_counters(spark, sf_dir):
    """What three runs of an incremental import count and store, in batches of a few files; the last run finds nothing."""
    source, target, checkpoint = (scratch_path(spark, f"ingest-{n}") for n in ("source", "target", "checkpoint"))
    docs = hars(spark, sf_dir).withColumn("release", release.release_of_path(F.col("path")))
    counted = []
    for client in ("chrome", "android", "nothing"):
        drop = docs.where(F.col("release").startswith(client)).select("doc", "release")
        drop.write.mode("append").partitionBy("release").text(source)
        counted.append(ingest.ingest_hars(spark, source, target, checkpoint, max_files_per_batch=64))
    stored = spark.read.parquet(target).where("table = 'response_bodies'")
    sums = [sum(c.get(name, 0) for c in counted) for name in ("with_body", "rejected")]
    return stored.agg(F.count(F.lit(1)).alias("bodies")).select(
        F.lit(sums[0]).cast("bigint").alias("with_body"), F.lit(sums[1]).cast("bigint").alias("rejected"),
        F.lit(len(counted)).alias("runs"), "bodies",
    )


_BUDGET = 1000


@register(f"""WITH c AS (SELECT doc_id, unnest(string_split(text, '')) AS c, unnest(range(1, length(text) + 1)) AS i FROM documents),
k AS (SELECT doc_id, i, sum(CASE WHEN c IN (chr(92), '"', '/') THEN 3 WHEN c IN (chr(8), chr(9), chr(10), chr(12), chr(13)) THEN 2
  WHEN ascii(c) < 16 THEN 8 WHEN ascii(c) < 32 THEN 9 ELSE strlen(c) END) OVER (PARTITION BY doc_id ORDER BY i) AS used FROM c)
SELECT d.doc_id, md5(substr(any_value(d.text), 1, coalesce(max(k.i), 0))) AS cut_md5
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id AND k.used <= {_BUDGET} * (1 + d.doc_id % 10) GROUP BY d.doc_id""")
def body_truncate_utf8(spark, sf_dir):
    """Whole texts cut to a byte budget that differs by document."""
    budget = F.lit(_BUDGET) * (1 + F.col("doc_id") % 10)
    cut = text.fit_json_bytes(F.col("text"), budget)
    documents = analogs.dealt(read(spark, sf_dir, "documents"))
    return documents.select("doc_id", F.md5(cut.cast("binary")).alias("cut_md5"))


@register("SELECT url, CAST(('0x' || right(sha256(url), 1))::INTEGER % 4 AS INTEGER) AS shard FROM pages")
def url_shards(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("url", scalar.url_shard(F.col("url")).alias("shard"))


@register("""SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS date,
  CASE o_custkey % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'ios' END AS client,
  CASE o_custkey % 3 WHEN 0 THEN 'desktop' ELSE 'mobile' END AS lenient_client,
  'har.' || strftime(date_trunc('month', o_orderdate), '%Y_%m_%d') || '_' || CASE o_custkey % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'ios' END AS target
FROM orders""")
def release_name(spark, sf_dir):
    name = F.concat(
        F.expr("CASE o_custkey % 3 WHEN 0 THEN 'chrome' WHEN 1 THEN 'android' ELSE 'ios' END"),
        F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "MM"), "-MMM_dd_yyyy"),
    )
    releases = read(spark, sf_dir, "orders").select(name.alias("release")).distinct()
    date, client = release.release_date(F.col("release")), release.release_client(F.col("release"))
    return releases.select(
        date.alias("date"),
        client.alias("client"),
        release.release_client(F.col("release"), strict=False).alias("lenient_client"),
        release.target_name("har", date, client).alias("target"),
    )


# ---------------------------------------------------------------- CSV dumps

_DUMP_SCHEMA = "id bigint, name string, note string, price double, open boolean"


def _dump_lines(spark: SparkSession, sf_dir: str, bad_from: int | None = None) -> DataFrame:
    """Orders as a database dump: ``\\N`` for NULL, escaped quotes, a row broken by a backslash."""
    quote = chr(92) * 2 + '"'
    line = F.concat_ws(
        ",",
        F.col("o_orderkey").cast("string"),
        F.expr(f"CASE WHEN o_orderkey % 5 = 0 THEN '{chr(92) * 2}N' ELSE '\"na {quote}' || o_custkey || '{quote} x\"' END"),
        F.expr(f"CASE WHEN o_orderkey % 7 = 0 THEN '\"one{chr(92) * 2}\\ntwo\"' ELSE '\"' || o_orderpriority || ', x\"' END"),
        # A break outside of quotes parts two fields, as the comma it becomes.
        F.concat(
            F.expr(f"CASE WHEN o_orderkey % 3 = 0 THEN '{chr(92) * 2}N' ELSE CAST(o_totalprice AS STRING) END"),
            F.expr(f"CASE WHEN o_orderkey % 4 = 0 THEN '{chr(92) * 2}\n' ELSE ',' END"),
            F.expr("CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE '0' END"),
        ),
    )
    return read(spark, sf_dir, "orders").select(line.alias("value"))


@register("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'na "' || o_custkey || '" x' END AS name,
  CASE WHEN o_orderkey % 7 = 0 THEN 'one, two' ELSE o_orderpriority || ', x' END AS note,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price, o_orderkey % 2 = 0 AS open,
  DATE '2018-12-15' AS date, 'mobile' AS client, CAST(10 AS BIGINT) AS bad_rows FROM orders""")
def csv_load(spark, sf_dir):
    """A gzip dump with ten bad rows, loaded as one partition and read back, with the number of rows set aside."""
    dump, target = scratch_path(spark, "csv"), scratch_path(spark, "csv-table")
    bad = spark.range(10).select(F.lit("not a number,x,y,z,0").alias("value"))
    _dump_lines(spark, sf_dir).unionByName(bad).write.option("compression", "gzip").text(dump)
    schema = spark.createDataFrame([], _DUMP_SCHEMA).schema
    rows = csvdump.load_dump(spark, dump, schema)
    archive = F.lit("mobile_Dec_15_2018")
    csvdump.write_partition(rows, target, release.archive_date(archive), release.archive_client(archive))
    kept = spark.read.parquet(csvdump.rejects_path(spark)).where(F.col("source") == dump)
    return spark.read.parquet(target).join(F.broadcast(kept.agg(F.count(F.lit(1)).alias("bad_rows"))))


@register("""SELECT 'bad ' || o_orderkey || ',x,y,z,0' AS line FROM orders WHERE o_orderkey % 50 = 0
UNION ALL SELECT o_orderkey || ',too,few' FROM orders WHERE o_orderkey % 50 = 1""")
def csv_rejects(spark, sf_dir):
    """Rows that do not fit are kept as they came, and the plain files are cut into blocks."""
    dump, kept = scratch_path(spark, "csv"), scratch_path(spark, "csv-rejects")
    orders = read(spark, sf_dir, "orders")
    bad = F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit("bad "), F.col("o_orderkey"), F.lit(",x,y,z,0"))).otherwise(
        F.concat(F.col("o_orderkey"), F.lit(",too,few"))
    )
    broken = orders.where("o_orderkey % 50 < 2").select(bad.alias("value"))
    _dump_lines(spark, sf_dir).unionByName(broken).write.text(dump)
    schema = spark.createDataFrame([], _DUMP_SCHEMA).schema
    csvdump.load_dump(spark, dump, schema, max_bad=10**9, rejects=kept)
    return spark.read.parquet(kept).select("line")


@register("""SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL""")
def dedup_keys(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return csvdump.first_of_each(items, ("l_orderkey", "l_linenumber"), "l_partkey")


# ---------------------------------------------------------------- sinks

_ORDER_SLICE = "o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS date"


def _slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", month.alias("date"))


@register(f"SELECT {_ORDER_SLICE} FROM orders UNION ALL SELECT {_ORDER_SLICE} FROM orders WHERE year(o_orderdate) = 1996")
def write_append(spark, sf_dir):
    path, rows = scratch_path(spark, "append"), _slices(spark, sf_dir)
    csvdump.write_slices(rows, path, ("date",))
    csvdump.write_slices(rows.where(F.year("date") == 1996), path, ("date",))
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "date")


@register(f"""SELECT o_orderkey, CASE WHEN year(date) = 1996 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, date
FROM (SELECT {_ORDER_SLICE} FROM orders)""")
def write_overwrite(spark, sf_dir):
    """Replaces only the partitions of one year."""
    path, rows = scratch_path(spark, "overwrite"), _slices(spark, sf_dir)
    csvdump.write_slices(rows, path, ("date",))
    changed = rows.where(F.year("date") == 1996).withColumn("o_totalprice", -F.col("o_totalprice"))
    csvdump.write_slices(changed, path, ("date",), replace=True)
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "date")


@register("SELECT count(*) AS n, CAST(ceil(count(*) / 1000.0) AS BIGINT) <= count(*) AS within FROM orders")
def write_split(spark, sf_dir):
    """Files of at most 1,000 rows each."""
    path = scratch_path(spark, "split")
    listings.write_json_lines(read(spark, sf_dir, "orders"), path, rows_per_file=1000)
    lines = spark.read.text(path).groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return lines.agg(F.sum("n").alias("n"), (F.max("n") <= 1000).alias("within"))


@register("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price, [o_orderstatus, o_orderpriority] AS tags FROM orders")
def json_lines_load(spark, sf_dir):
    """Gzip JSON lines out, then loaded into a table of a declared schema with a repeated column."""
    lines, table = scratch_path(spark, "json"), scratch_path(spark, "json-table")
    price = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price")
    rows = read(spark, sf_dir, "orders").select("o_orderkey", price, F.array("o_orderstatus", "o_orderpriority").alias("tags"))
    listings.write_json_lines(rows, lines)
    return listings.load_json_lines(spark, lines, table, "o_orderkey bigint, price double, tags array<string>")


# ---------------------------------------------------------------- listings and classification

_HOST_SQL = "regexp_extract(url, '^https?://([^/?#]*)', 1)"
_DOMAIN_SQL = "array_to_string(list_slice(string_split({h}, '.'), -2, -1), '.')".format(h=_HOST_SQL)
_PARTS_SQL = f"list_slice(string_split({_HOST_SQL}, '.'), 1, -3)"


@register(f"""WITH e AS (SELECT page_id, {_DOMAIN_SQL} AS d, array_to_string({_PARTS_SQL}, '.') AS sub, url,
    '/' AS path, length(html) AS size FROM pages),
entries AS (SELECT *, 'http://' || CASE WHEN page_id % 3 = 0 THEN 'www.' ELSE '' END || 'site' || (size % 50) || '.' || split_part(d, '.', 2)
    || CASE page_id % 7 WHEN 0 THEN '/?q' WHEN 1 THEN '/deep' WHEN 2 THEN '' ELSE '/' END AS entry FROM e),
kept AS (SELECT page_id, 'site' || (size % 50) || '.' || split_part(d, '.', 2) AS domain, entry FROM entries WHERE page_id % 7 > 1),
g AS (SELECT domain, list('Top/' || page_id % 11 ORDER BY page_id) AS topics, arg_min(entry, page_id) AS url, arg_min('t' || page_id, page_id) AS title FROM kept GROUP BY domain),
ranked AS (SELECT 'site' || r || '.' || s AS domain, r * 3 + length(s) AS rank FROM (SELECT DISTINCT size % 50 AS r, split_part(d, '.', 2) AS s FROM e UNION SELECT 99, 'com'))
SELECT ranked.domain AS alexa_domain, CAST(ranked.rank AS BIGINT) AS alexa_rank, CAST(0 AS INTEGER) AS part, array_to_string(coalesce(topics, []), '|') AS topics, g.url AS dmoz_url, title AS dmoz_title
FROM ranked LEFT JOIN g USING (domain)""")
def rank_directory_join(spark, sf_dir):
    """Domains ranked by a made-up key, joined to directory entries derived from the web pages."""
    pages = read(spark, sf_dir, "pages").select(
        "page_id",
        (F.length("html") % 50).alias("r"),
        F.substring_index(weburl.registered_domain(F.col("url")), ".", -1).alias("s"),
    )
    domain = F.concat(F.lit("site"), F.col("r"), F.lit("."), F.col("s"))
    more = spark.createDataFrame([(99, "com")], "r int, s string")
    ranked = pages.select("r", "s").union(more).distinct().select(
        domain.alias("alexa_domain"), (F.col("r") * 3 + F.length("s")).alias("alexa_rank")
    )
    tail = F.expr("CASE page_id % 7 WHEN 0 THEN '/?q' WHEN 1 THEN '/deep' WHEN 2 THEN '' ELSE '/' END")
    www = F.when(F.col("page_id") % 3 == 0, "www.").otherwise("")
    entries = pages.select(
        F.col("page_id").alias("position"),
        F.concat(F.lit("http://"), www, domain, tail).alias("url"),
        F.concat(F.lit("t"), F.col("page_id")).alias("title"),
        F.lit("").alias("description"),
        F.concat(F.lit("Top/"), F.col("page_id") % 11).alias("topic"),
    )
    # A domain listed twice keeps its last rank.
    twice = ranked.unionByName(ranked.where("alexa_rank % 4 = 0").withColumn("alexa_rank", F.col("alexa_rank") - 1))
    joined = directory.ranked_directory(twice, entries)
    return joined.select(
        "alexa_domain", "alexa_rank", "part", F.array_join("dmoz_topic", "|").alias("topics"), "dmoz_url", "dmoz_title"
    )


@register("""SELECT CASE WHEN page_id % 4 = 0 THEN 'hot.example' ELSE 'd' || page_id || '.example' END AS domain, count(*) AS topics,
  CAST(sum(page_id) AS BIGINT) AS total FROM pages GROUP BY ALL""")
def rank_directory_parts(spark, sf_dir):
    """A domain with a quarter of all entries, in rows of a few topics: none is lost, none comes twice."""
    pages = read(spark, sf_dir, "pages").select("page_id")
    name = F.expr("CASE WHEN page_id % 4 = 0 THEN 'hot.example' ELSE 'd' || page_id || '.example' END")
    ranked = pages.select(name.alias("alexa_domain"), F.col("page_id").alias("alexa_rank"))
    entries = pages.select(
        F.col("page_id").alias("position"), F.concat(F.lit("http://"), name, F.lit("/")).alias("url"),
        F.lit("t").alias("title"), F.lit("").alias("description"), F.col("page_id").cast("string").alias("topic"),
    )
    rows = directory.ranked_directory(ranked, entries, topics_per_row=5)
    each = rows.select("alexa_domain", "part", F.explode("dmoz_topic").alias("t"))
    return each.groupBy(F.col("alexa_domain").alias("domain")).agg(
        F.count(F.lit(1)).alias("topics"), F.sum(F.col("t").cast("bigint")).alias("total")
    )


@register("""SELECT 'http://d' || page_id || '.example/' AS url, 'T & ' || page_id AS title, '' AS description, 'Top/' || page_id % 9 AS topic,
  CAST(page_id AS INTEGER) AS rank, 'd' || page_id || '.example' AS domain FROM pages""")
def directory_read(spark, sf_dir):
    """A directory dump as XML and a ranked list as CSV, written and read back."""
    xml, ranks = scratch_path(spark, "directory"), scratch_path(spark, "ranks")
    pages = read(spark, sf_dir, "pages")
    entry = F.concat(
        F.lit('<ExternalPage about="http://d'), F.col("page_id"), F.lit('.example/">\n  <d:Title>T &amp; '), F.col("page_id"),
        F.lit("</d:Title>\n  <topic>Top/"), F.col("page_id") % 9, F.lit("</topic>\n</ExternalPage>"),
    )
    pages.select(entry.alias("value")).write.text(xml)
    pages.select("page_id", F.concat(F.lit("d"), F.col("page_id"), F.lit(".example"))).write.csv(ranks)
    listed = listings.read_directory(spark, xml)
    ranked = listings.read_ranked_domains(spark, ranks)
    joined = directory.domain_topics(ranked, listed)
    return joined.select(
        "url", "title", "description", "topic", F.col("alexa_rank").cast("int").alias("rank"), F.col("alexa_domain").alias("domain")
    )


# Small lists with every kind of rule; the check SQL spells out what each of them means.
RULES = {
    "ad": (
        "! comment",
        "||cheap-pills.example.com^",
        "||spam-farm.example.org^$third-party",
        "/fr/8*?page=$domain=example.net|~blog.example.net",
        "@@||spam-farm.example.org/en/",
        "example.com##.banner",
        "||ignored.example.org^$script",
    ),
    "tracker": ("utm_source=", "@@|https://*utm_source=feed|", "/[0-9]{3}\\.html$/"),
    "social": ("/de/", "||example.net/es/"),
}
_THIRD = f"(page_domain <> {_DOMAIN_SQL})"


@register(rf"""WITH r AS (SELECT CASE WHEN page_id % 2 = 0 THEN url ELSE 'http://www.example.net/' END AS page, url FROM pages),
d AS (SELECT *, CASE WHEN page = url THEN {_DOMAIN_SQL} ELSE 'example.net' END AS page_domain FROM r),
h AS (SELECT *, {_HOST_SQL} AS host FROM d),
b AS (SELECT page, url,
  ((host = 'cheap-pills.example.com' OR host LIKE '%.cheap-pills.example.com')
    OR ((host = 'spam-farm.example.org' OR host LIKE '%.spam-farm.example.org') AND {_THIRD})
    OR (regexp_matches(url, '/fr/8.*\?page=') AND page_domain = 'example.net'))
    AND NOT ((host = 'spam-farm.example.org' OR host LIKE '%.spam-farm.example.org') AND regexp_matches(url, '^https?://[^/]*/en/')) AS ad,
  (url LIKE '%utm_source=%' AND NOT regexp_matches(url, '^https://.*utm_source=feed$')) OR regexp_matches(url, '[0-9]{{3}}\.html$') AS tracker,
  url LIKE '%/de/%' OR regexp_matches(url, '^https?://([^/?#]*\.)?example\.net/es/') AS social FROM h)
SELECT page, url, CASE WHEN ad THEN 'ad' WHEN tracker THEN 'tracker' WHEN social THEN 'social' ELSE '' END AS type FROM b""")
def classify_requests(spark, sf_dir):
    """Requests classified by rule lists read from text files."""
    paths = {}
    for name, rules in RULES.items():
        paths[name] = scratch_path(spark, f"rules-{name}")
        spark.createDataFrame([(rule,) for rule in rules], "value string").coalesce(1).write.text(paths[name])
    rules = classify.parse_rules(listings.read_rule_lists(spark, paths))
    page = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise("http://www.example.net/")
    return classify.classify(analogs.dealt(read(spark, sf_dir, "pages")).select(page.alias("page"), "url"), rules)


# Which pages give a rule of each kind.
_HOST_RULES, _PATH_RULES, _RUN_RULES, _EXPRESSION_RULES = "page_id % 7 = 0", "page_id % 3 = 0", "page_id % 5 < 2", "page_id % 4 = 0"


@register(f"""WITH p AS (SELECT page_id, url, {_HOST_SQL} AS host FROM pages),
hosts AS (SELECT DISTINCT host FROM p WHERE {_HOST_RULES}),
paths AS (SELECT DISTINCT '/' || (page_id % 1000) || '?' AS r FROM p WHERE {_PATH_RULES} UNION SELECT DISTINCT '/' || (page_id % 1000) || '/' FROM p WHERE {_PATH_RULES}),
runs AS (SELECT DISTINCT 'n/' || (page_id % 700) || '?u' AS r FROM p WHERE {_RUN_RULES}),
expressions AS (SELECT DISTINCT '/' || (page_id % 500) || '.html' AS r FROM p WHERE {_EXPRESSION_RULES}),
f AS (SELECT p.page_id, p.url,
  EXISTS (SELECT 1 FROM hosts h WHERE p.host = h.host OR ends_with(p.host, '.' || h.host)) AS h,
  EXISTS (SELECT 1 FROM paths WHERE contains(p.url, paths.r)) AS pa,
  EXISTS (SELECT 1 FROM runs WHERE contains(p.url, runs.r)) AS ru,
  EXISTS (SELECT 1 FROM expressions WHERE ends_with(p.url, expressions.r) AND regexp_matches(p.url, '[a-z]/[0-9]+\\.html$')) AS e FROM p)
SELECT url AS page, url, CASE WHEN h AND NOT e THEN 'hosts' WHEN pa THEN 'paths' WHEN ru THEN 'runs' WHEN e THEN 'expressions' ELSE '' END AS type FROM f""")
def classify_generated(spark, sf_dir):
    """Requests against thousands of rules derived from the pages themselves, of every kind a rule is filed under."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", weburl.host(F.col("url")).alias("host"))
    number = lambda n: (F.col("page_id") % n).cast("string")
    html = F.concat(F.lit("/[a-z]\\/"), number(500), F.lit("\\.html$/"))
    lists = (
        ("hosts", _HOST_RULES, (F.concat(F.lit("||"), F.col("host"), F.lit("^")),)),
        ("hosts", _EXPRESSION_RULES, (F.concat(F.lit("@@"), html),)),
        ("paths", _PATH_RULES, (F.concat(F.lit("/"), number(1000), F.lit("?")), F.concat(F.lit("/"), number(1000), F.lit("/|")), F.concat(F.lit("/"), number(1000), F.lit("/?")))),
        ("runs", _RUN_RULES, (F.concat(F.lit("n/"), number(700), F.lit("?u")),)),
        ("expressions", _EXPRESSION_RULES, (html,)),
    )
    lines = None
    for i, (name, which, rules) in enumerate(lists):
        made = pages.where(which).select(F.lit(name).alias("list"), F.lit(max(i - 1, 0)).alias("priority"), F.explode(F.array(*rules)).alias("line"))
        lines = made if lines is None else lines.unionByName(made)
    rules = classify.parse_rules(lines.distinct())
    return classify.classify(analogs.dealt(read(spark, sf_dir, "pages")).select(F.col("url").alias("page"), "url"), rules)


@register(f"""SELECT url, {_HOST_SQL} AS host, {_DOMAIN_SQL} AS domain, array_to_string({_PARTS_SQL}, '.') AS subdomain FROM pages""")
def url_domains(spark, sf_dir):
    url = F.col("url")
    return read(spark, sf_dir, "pages").select(
        "url", weburl.host(url).alias("host"), weburl.registered_domain(url).alias("domain"), weburl.subdomain(url).alias("subdomain")
    )


# ---------------------------------------------------------------- report runs

_PAGES = report_queries.pages_sql()
_REQUESTS = f"SELECT p.* FROM lineitem JOIN ({_PAGES}) p ON l_orderkey = o_orderkey"


@register(f"""SELECT date, 'pages' AS source, client, is_root_page, count(*) AS rows FROM ({_PAGES}) GROUP BY ALL
UNION ALL SELECT date, 'requests', client, is_root_page, count(*) FROM ({_REQUESTS}) GROUP BY ALL""")
def readiness_gate(spark, sf_dir):
    return reports.readiness(analogs.tables(spark, sf_dir))


@register(f"""WITH s AS (SELECT DISTINCT date, 'pages' AS source, client, is_root_page FROM ({_PAGES})
  UNION SELECT DISTINCT date, 'requests', client, is_root_page FROM ({_REQUESTS}))
SELECT date FROM s GROUP BY date HAVING count(*) = 8""")
def ready_dates(spark, sf_dir):
    return reports.ready_dates(analogs.tables(spark, sf_dir))


@register(f"SELECT DISTINCT strftime(date, '%Y_%m_%d') AS date FROM ({_PAGES}) WHERE date BETWEEN DATE '2017-01-01' AND DATE '2021-12-01'")
def list_dates(spark, sf_dir):
    return reports.list_dates(analogs.crawl_pages(spark, sf_dir), "2017_01_01", "2021_12_01")


@register("""SELECT DISTINCT '20' || strftime(o_orderdate, '%y_%m_01') AS date FROM orders WHERE o_orderkey % 2 = 0
  AND '20' || strftime(o_orderdate, '%y_%m_01') >= '2000_01_01' AND '20' || strftime(o_orderdate, '%y_%m_01') < '2050'""")
def list_shard_dates(spark, sf_dir):
    """Shards named by date and kind, of which one kind is listed; the century is added back."""
    suffix = F.concat(
        F.date_format("o_orderdate", "yy_MM_01"),
        F.when(F.col("o_orderkey") % 2 == 0, "_desktop_pages").otherwise("_desktop_requests"),
    )
    shards = read(spark, sf_dir, "orders").select(suffix.alias("suffix"))
    return reports.list_shard_dates(shards, "pages", "2000_01_01", "2050")


@register("""SELECT '20' || strftime(date_trunc('year', o_orderdate), '%y_01_01') AS date, count(*) AS n FROM orders
WHERE o_orderkey % 2 = 0 GROUP BY ALL""")
def shard_scan(spark, sf_dir):
    """Tables sharded by folder name, scanned by a wildcard; the dates go through a CSV file."""
    root, path = scratch_path(spark, "shards"), scratch_path(spark, "dates")
    kind = F.when(F.col("o_orderkey") % 2 == 0, "pages").otherwise("requests")
    name = F.concat(F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "YEAR"), "yy_MM_dd"), F.lit("_desktop_"), kind)
    orders = read(spark, sf_dir, "orders").select("o_orderkey", name.alias("t"))
    orders.write.partitionBy("t").parquet(root)
    # Partition folders are named t=<shard>, which the prefix strips.
    shards = listings.read_shards(spark, root, "t=")
    listings.write_dates(reports.list_shard_dates(shards, "pages"), path)
    dates = spark.read.schema("date string").csv(path)
    counted = shards.where(F.col("suffix").endswith("_pages")).groupBy(scalar.shard_date(F.col("suffix")).alias("date"))
    return dates.join(counted.agg(F.count(F.lit(1)).alias("n")), "date")


def _long_series(names, lens_names, where: str = "TRUE") -> str:
    """Check SQL of series in long form: one column ``value`` per measure that a report has."""
    parts = []
    for lens in lens_names:
        for name in names:
            measures = series.REPORT_MEASURES[type(m.SERIES[name])]
            columns = ", ".join(
                f"CAST({c if c in measures else 'NULL'} AS {t}) AS {c}" for c, t in series.MEASURES.items()
            )
            sql = report_queries.series_sql(name, lens)
            parts.append(f"SELECT '{lens}' AS lens, '{name}' AS metric, date, timestamp, client, {columns} FROM ({sql}) WHERE {where}")
    return " UNION ALL ".join(parts)


_ALL_LENSES = [lenses.BASE, *lenses.LENSES]


def _store(spark: SparkSession) -> reports.ReportStore:
    return reports.ReportStore(spark, scratch_path(spark, "reports"))


def _columns(table: DataFrame) -> DataFrame:
    return table.select("lens", "metric", "date", "timestamp", "client", *series.MEASURES)


@register(_long_series(["numUrls", "bytesTotal"], ["base", "top10k"]))
def incremental_append(spark, sf_dir):
    """A run up to one date, then the rest: equals one full run."""
    tables, store = analogs.tables(spark, sf_dir), _store(spark)
    for date in ("2019_06_01", None):
        for lens in (None, "top10k"):
            for pattern in ("numUrls", "bytesTotal"):
                reports.run_series(tables, store, date, lens, pattern)
    return _columns(store.series())


@register(_long_series(["numUrls"], ["base"], "date <= '2018_03_01'"))
def force_rerun(spark, sf_dir):
    """A forced run recomputes the series up to the date, whatever was there."""
    tables, store = analogs.tables(spark, sf_dir), _store(spark)
    reports.run_series(tables, store, pattern="numUrls")
    reports.run_series(tables, store, "2018_03_01", pattern="numUrls", force=True)
    return _columns(store.series())


@register(_long_series(["numUrls", "ol"], ["base"], "metric = 'ol' OR date <> '2018_03_01'"))
def delete_date(spark, sf_dir):
    tables, store = analogs.tables(spark, sf_dir), _store(spark)
    reports.run_series(tables, store, pattern="numUrls")
    reports.run_series(tables, store, pattern="ol")
    reports.delete_date(store, "2018_03_01", pattern="num*")
    return _columns(store.series())


def _long_histograms(names, lens_names, where: str = "TRUE") -> str:
    parts = []
    for lens in lens_names:
        for name in names:
            sql = report_queries.histogram_sql(name, lens)
            parts.append(
                f"SELECT '{lens}' AS lens, '{name}' AS metric, date, client, CAST(bin AS DOUBLE) AS bin, CAST(volume AS DOUBLE) AS volume, pdf, cdf FROM ({sql}) WHERE {where}"
            )
    return " UNION ALL ".join(parts)


_BACKFILLED = ("2018_03_01", "2019_06_01")


@register(_long_histograms(["bytesTotal", "reqTotal"], ["base", "top10k"], "date IN (DATE '2018-03-01', DATE '2019-06-01')"))
def backfill(spark, sf_dir):
    """Histograms of two dates, one of them there already for one metric."""
    tables, store = analogs.tables(spark, sf_dir), _store(spark)
    reports.backfill(tables, store, _BACKFILLED[:1], None, "bytesTotal")
    for lens in (None, "top10k"):
        for pattern in ("bytesTotal", "reqTotal"):
            reports.backfill(tables, store, _BACKFILLED, lens, pattern)
    rows = store.histograms().withColumn("date", scalar.parse_report_date(F.col("date")))
    return rows.withColumns({"pdf": F.round("pdf", 8), "cdf": F.round("cdf", 8)})


@register(_long_series(["numUrls", "bytesTotal"], ["base"]))
def published_series_import(spark, sf_dir):
    """Series exported as JSON reports, brought into another store."""
    tables, store, other = analogs.tables(spark, sf_dir), _store(spark), _store(spark)
    path = scratch_path(spark, "published")
    for name in ("numUrls", "bytesTotal"):
        reports.run_series(tables, store, pattern=name)
    reports.export_series(store, path)
    for name in ("numUrls", "bytesTotal"):
        reports.import_series(other, f"{path}/lens=base/metric={name}", "base", name, lines=True)
    return _columns(other.series())


@register(_long_series(["numUrls", "bytesTotal"], ["base"]))
def published_array_import(spark, sf_dir):
    """Series published as one JSON array each, over several lines, brought into a store that has one of them already."""
    tables, store, other = analogs.tables(spark, sf_dir), _store(spark), _store(spark)
    path = scratch_path(spark, "published")
    for name in ("numUrls", "bytesTotal"):
        reports.run_series(tables, store, pattern=name)
    reports.run_series(tables, other, "2018_03_01", pattern="numUrls")
    whole = store.series().select("metric", F.struct("date", "timestamp", "client", *series.MEASURES).alias("r"))
    arrays = whole.groupBy("metric").agg(F.to_json(F.sort_array(F.collect_list("r"))).alias("value"))
    arrays = arrays.withColumn("value", F.replace("value", F.lit("},{"), F.lit("},\n{")))
    arrays.repartition("metric").write.partitionBy("metric").text(path)
    for name in ("numUrls", "bytesTotal"):
        reports.import_series(other, f"{path}/metric={name}", "base", name)
    return _columns(other.series())


def _placed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of exported reports with their place in the file, from 0."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i"))
    place = F.row_number().over(Window.partitionBy("f").orderBy("i")) - 1
    return lines.select(place.alias("place"), F.from_json("value", schema).alias("r")).select("place", "r.*")


_ORDERED = _long_histograms(["bytesTotal"], ["base"], "date = DATE '2021-05-01'")


@register(f"""SELECT 'histogram' AS report, CAST(row_number() OVER (ORDER BY bin NULLS FIRST, client) - 1 AS INTEGER) AS place, client,
  CAST(bin AS VARCHAR) AS label FROM (SELECT client, CAST(bin AS BIGINT) AS bin FROM ({_ORDERED}))
UNION ALL SELECT 'series', CAST(row_number() OVER (ORDER BY date DESC, client) - 1 AS INTEGER), client, date FROM ({_long_series(["bytesTotal"], ["base"])})""")
def export_order(spark, sf_dir):
    """Exported rows in the order a reader meets them: histograms by bin and client, series newest first."""
    tables, store, path = analogs.tables(spark, sf_dir), _store(spark), scratch_path(spark, "export")
    reports.run_reports(tables, store, "2021_05_01", pattern="bytesTotal")
    reports.run_series(tables, store, pattern="bytesTotal")
    reports.export_histograms(store, f"{path}/h", "2021_05_01")
    reports.export_series(store, f"{path}/t")
    bins = _placed(spark, f"{path}/h/lens=base/date=2021_05_01/metric=bytesTotal", "client string, bin double")
    dates = _placed(spark, f"{path}/t/lens=base/metric=bytesTotal", "client string, date string")
    bins = bins.select(F.lit("histogram").alias("report"), "place", "client", F.col("bin").cast("bigint").cast("string").alias("label"))
    return bins.unionByName(dates.select(F.lit("series").alias("report"), "place", "client", F.col("date").alias("label")))


_RUN_DATE = "2021-05-01"


@register(_long_histograms(["bytesCss", "bytesTotal"], _ALL_LENSES, f"date = DATE '{_RUN_DATE}'"))
def run_reports(spark, sf_dir):
    """Histograms of a date through every lens; a second run skips what exists."""
    tables, store = analogs.tables(spark, sf_dir), _store(spark)
    reports.run_reports(tables, store, _RUN_DATE.replace("-", "_"), pattern="bytesCss")
    for pattern in ("bytesCss", "bytesTotal"):
        reports.run_reports(tables, store, _RUN_DATE.replace("-", "_"), lens="ALL", pattern=pattern)
    rows = store.histograms().withColumn("date", scalar.parse_report_date(F.col("date")))
    return rows.withColumns({"pdf": F.round("pdf", 8), "cdf": F.round("cdf", 8)})


@register(_long_series(["bytesJs", "h2"], ["base", "wordpress"]))
def export_reports(spark, sf_dir):
    """Series exported as JSON reports and read back."""
    tables, store, path = analogs.tables(spark, sf_dir), _store(spark), scratch_path(spark, "export")
    for pattern in ("bytesJs", "h2"):
        for lens in (None, "wordpress"):
            reports.run_series(tables, store, lens=lens, pattern=pattern)
    reports.export_series(store, path)
    return _columns(spark.read.schema(reports.SERIES_SCHEMA).json(path))


# ---------------------------------------------------------------- many reports from one scan

_SCAN_HISTOGRAMS = [x.name for x in m.CRAWL_HISTOGRAMS if x.source == "pages"]
_SCAN_SERIES = [x.name for x in m.PAGE_SERIES]


@register(_long_histograms(_SCAN_HISTOGRAMS, ["base"]))
def one_scan_histograms(spark, sf_dir):
    """Every page histogram of every date from one scan."""
    chosen = [m.HISTOGRAMS[n] for n in _SCAN_HISTOGRAMS]
    long = histograms.histograms(analogs.tables(spark, sf_dir), chosen, [lenses.get(lenses.BASE)])
    return long.withColumns({"pdf": F.round("pdf", 8), "cdf": F.round("cdf", 8)})


@register(_long_histograms(["bytesTotal", "reqTotal", "speedIndex"], _ALL_LENSES))
def one_scan_lenses(spark, sf_dir):
    """Three histograms through all lenses from one scan."""
    chosen = [m.HISTOGRAMS[n] for n in ("bytesTotal", "reqTotal", "speedIndex")]
    long = histograms.histograms(analogs.tables(spark, sf_dir), chosen, lenses.select(lenses.ALL))
    return long.withColumns({"pdf": F.round("pdf", 8), "cdf": F.round("cdf", 8)})


@register(_long_series(_SCAN_SERIES, ["base"]))
def one_scan_series(spark, sf_dir):
    """Every page series from one aggregate."""
    chosen = [m.SERIES[n] for n in _SCAN_SERIES]
    return series.series(analogs.tables(spark, sf_dir), chosen, [lenses.get(lenses.BASE)])


@register(_long_series([x.name for x in m.REQUEST_SHARES], _ALL_LENSES))
def one_join_requests(spark, sf_dir):
    """All request shares through all lenses from one join."""
    return series.series(analogs.tables(spark, sf_dir), list(m.REQUEST_SHARES), lenses.select(lenses.ALL))


@register(_long_series([x.name for x in (*m.RUM_SHARES, m.RUM_VITALS)], ["base"]))
def one_scan_rum_series(spark, sf_dir):
    """All real-user shares from one aggregate per site."""
    chosen = [*m.RUM_SHARES, m.RUM_VITALS]
    long = series.series(analogs.tables(spark, sf_dir), chosen, [lenses.get(lenses.BASE)])
    return long.withColumn("percent", F.round("percent", 8))


@register(_long_histograms([x.name for x in m.RUM_HISTOGRAMS], _ALL_LENSES))
def one_scan_rum_histograms(spark, sf_dir):
    """Every real-user histogram through all lenses, from one pass and one join."""
    long = histograms.histograms(analogs.tables(spark, sf_dir), list(m.RUM_HISTOGRAMS), lenses.select(lenses.ALL))
    return long.withColumns({"volume": F.round("volume", 6), "pdf": F.round("pdf", 8), "cdf": F.round("cdf", 8)})


@register(_long_histograms(["bytesTotal", "tcp"], ["base"]))
def typed_facts(spark, sf_dir):
    """Histograms from page facts extracted once into a typed table."""
    path = scratch_path(spark, "facts")
    facts.write_page_facts(analogs.crawl_pages(spark, sf_dir), path)
    tables = CrawlTables(pages=spark.read.parquet(path))
    long = histograms.histograms(tables, [m.HISTOGRAMS[n] for n in ("bytesTotal", "tcp")], [lenses.get(lenses.BASE)])
    return long.withColumns({"pdf": F.round("pdf", 8), "cdf": F.round("cdf", 8)})


def queries() -> dict:
    return QUERIES
