"""HAR documents to five tables: pages, requests, response bodies, audits and technologies.

A document is parsed once. All tables leave the parse as tagged rows, so one job reads every
document once and writes all tables, partitioned by table, date and client, without a cache.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from sitepulse.functions import text
from sitepulse.session import exists, observed
from sitepulse.sources import release as release_

TABLES = {
    "pages": ("url", "payload"),
    "requests": ("page", "url", "payload"),
    "response_bodies": ("page", "url", "body", "truncated", "request_id"),
    "lighthouse": ("url", "report"),
    "technologies": ("url", "category", "app", "info"),
    # Documents without a usable page, and what a size limit keeps out of the other tables.
    "rejects": ("url", "payload", "info"),
    "oversize": ("page", "url", "payload", "info"),
}

# Every column any table has; a tagged row fills those of its own table.
ROW = (
    "table string, page string, url string, payload string, body string, truncated boolean, "
    "request_id string, report string, category string, app string, info string, skipped boolean"
)

# Only these members of a document and of an entry are read; the rest is kept as text.
_DOCUMENT = "log struct<pages: array<string>, entries: array<string>>, _lighthouse string, _corrupt string"
_PAGE = (
    "_URL string, _metadata struct<tested_url: string, crawl_depth: string>, "
    "_detected string, _detected_apps string"
)
_ENTRY = (
    "_full_url string, url string, _request_id string, _id string, _raw_id string, "
    "response struct<content: string>"
)


@dataclass(frozen=True)
class HarOptions:
    """Size limits and fallbacks of the two generations of the import."""

    # No limit unless asked for; what exceeds one goes to the table ``oversize``.
    max_size: int | None = None
    # Sizes in UTF-8 bytes, bodies cut to what fits in a JSON row; otherwise in characters.
    in_bytes: bool = False
    # Fall back to ``url`` and then to an empty one when a request has no full URL.
    url_fallback: bool = False


CURRENT = HarOptions()
# The row limits of the two published generations.
LIMITED = HarOptions(max_size=2 * 1024 * 1024)
LEGACY = HarOptions(max_size=100 * 1024 * 1024, in_bytes=True, url_fallback=True)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Documents from text files with one JSON document per line: columns ``doc, path``."""
    return spark.read.text(path).select(F.col("value").alias("doc"), F.col("_metadata.file_path").alias("path"))


# Small files a task reads. A split holds some 32 of them, and a task for each would take longer to start than to read them.
_FILES = 512


def _folders(spark: SparkSession, folder: str) -> list[str] | None:
    """The folders a glob finds, if they hold nothing but files; None where only the glob itself tells what it finds."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    try:
        files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        # Only folders have an entry ".", which has to be escaped, or a path is shortened by it.
        found = [each.getPath().toString() for each in files.globStatus(path(f"{folder}/\\.")) or ()]
        if not found or any(set(name) & set("*?[]{}\\") for name in found):
            return None
        with ThreadPoolExecutor(8) as listing:
            nested = any(listing.map(lambda name: len(files.globStatus(path(f"{name}/*/\\."))), found))
        return None if nested else found
    except Py4JJavaError:
        return None


def _whole_files(spark: SparkSession, glob: str) -> DataFrame:
    """Columns ``path, doc`` of the files a glob finds, as text or as gzip bytes.

    Folders are listed by name pattern: a glob is a path for every file it finds, each listed on its own. Spark's text reader
    copies the whole configuration for every file, under a lock all tasks of an executor share; its reader of bytes does not.
    """
    folder, _, name = glob.rpartition("/")
    wild = set(name) & set("*?[{") and folder and all(folder.count(a) == folder.count(b) for a, b in ("{}", "[]"))
    folders = _folders(spark, folder) if wild else None
    path = F.col("_metadata.file_path").alias("path")
    if folders:
        reader = spark.read.option("pathGlobFilter", name)
        if name.endswith(".gz") and spark.conf.get("spark.sql.files.ignoreCorruptFiles") != "true":
            files = reader.format("binaryFile").load(folders).select(path, F.col("content").alias("doc"))
        else:
            files = reader.text(folders, wholetext=True).select(path, F.col("value").alias("doc"))
        # A glob that finds nothing is an error, which is the glob's to raise.
        if files.rdd.getNumPartitions():
            return files
    return spark.read.text(glob, wholetext=True).select(path, F.col("value").alias("doc"))


# Bytes of documents that leave a Python worker at once, but for a longer document.
_BYTES = 16 * 1024 * 1024


def _unpacked(files: DataFrame) -> DataFrame:
    """Gzip bytes to text, in batches of bounded size."""
    most = _BYTES

    def unpack(batches):
        import gzip

        import pyarrow as pa

        for batch in batches:
            paths, docs, size = [], [], 0
            for path, packed in zip(*batch.columns):
                doc = gzip.decompress(packed.as_py())
                if docs and size + len(doc) > most:
                    yield pa.RecordBatch.from_pydict({"path": paths, "doc": docs})
                    paths, docs, size = [], [], 0
                paths.append(path.as_py())
                docs.append(doc)
                size += len(doc)
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "doc": pa.array(docs, pa.binary())})

    # To text in Spark, which keeps bytes that are none.
    return files.mapInArrow(unpack, "path string, doc binary").withColumn("doc", F.col("doc").cast("string"))


def read_files(spark: SparkSession, glob: str, partitions: int | None = None) -> DataFrame:
    """Documents from (gzip) files of one document each, found by a glob.

    ``partitions`` spreads the documents before the expensive parse, where the files come in fewer splits.
    """
    files = _whole_files(spark, glob)
    splits = files.rdd.getNumPartitions()
    conf = spark._jsparkSession.sessionState().conf()
    most = max(1, _FILES * conf.filesOpenCostInBytes() // conf.filesMaxPartitionBytes())
    least = max(4 * spark.sparkContext.defaultParallelism, partitions or 0)
    packed = files.coalesce(max(-(-splits // most), least)) if splits > least else files
    docs = (_unpacked(packed) if dict(files.dtypes)["doc"] == "binary" else packed).select("doc", "path")
    # Many files come in many splits already; dealing those to a fixed number would make the longest task grow with them.
    return docs.repartition(partitions) if partitions and splits < partitions else docs


def with_release(docs: DataFrame) -> DataFrame:
    """Add ``date`` and ``client`` from the release folder of each file."""
    name = release_.release_of_path(F.col("path"))
    return docs.withColumns({"date": release_.release_date(name), "client": release_.release_client(name)})


def _exceeds(size: Column, options: HarOptions) -> Column:
    return F.lit(False) if options.max_size is None else size > F.lit(options.max_size)


def _size(value: Column, options: HarOptions) -> Column:
    return F.octet_length(value) if options.in_bytes else F.length(value)


def _compact(json: Column) -> Column:
    """JSON text without blanks between members. Text with strings too long for that is kept as it is."""
    return F.coalesce(F.get_json_object(json, "$"), F.when(F.left(json, F.lit(1)).isin("{", "["), json))


def parse(docs: DataFrame) -> DataFrame:
    """Split each document into its page, entries and audit report, as compact JSON texts.

    Adds ``page_url`` (the tested URL, or else the page's own), ``own_url``, ``payload``,
    ``entries``, ``report``, ``crawl_depth``, ``detected`` and ``detected_apps``. Lines that hold no
    page get NULLs.
    """
    split = docs.withColumn("_d", F.from_json("doc", _DOCUMENT, text.ANY_LENGTH | {"columnNameOfCorruptRecord": "_corrupt"}))
    page = split.withColumns(
        {
            "payload": _compact(F.get(F.col("_d.log.pages"), F.lit(0))),
            "entries": F.col("_d.log.entries"),
            "report": _compact(F.col("_d._lighthouse")),
            "_broken": F.col("_d._corrupt").isNotNull(),
        }
    ).withColumn("_p", F.from_json("payload", _PAGE, text.ANY_LENGTH))
    return page.withColumns(
        {
            "page_url": F.coalesce(F.col("_p._metadata.tested_url"), F.col("_p._URL")),
            "own_url": F.col("_p._URL"),
            "crawl_depth": F.col("_p._metadata.crawl_depth"),
            "detected": F.col("_p._detected"),
            "detected_apps": F.col("_p._detected_apps"),
        }
    ).drop("_d", "_p")


def reject_reason() -> Column:
    """Why a parsed document has no usable page, or NULL."""
    return (
        F.when(F.col("_broken") & F.expr("try_parse_json(doc)").isNull(), "unparsable")
        .when(F.col("payload").isNull() | (F.col("payload") == "{}"), "no page")
        .when(F.coalesce(F.col("page_url"), F.lit("")) == "", "no url")
    )


def rejects(docs: DataFrame) -> DataFrame:
    """Documents without a usable page, with the reason."""
    reason = reject_reason()
    # Unnested, not filtered: a filter on parsed values would move below the parse and repeat it.
    found = F.when(reason.isNotNull(), F.array(F.struct("path", "doc", reason.alias("reason"))))
    return parse(docs).select(F.inline(found))


def _is_home() -> Column:
    """A document without metadata is a home page."""
    return F.coalesce(F.col("crawl_depth"), F.lit("")).isin("", "0", "false")


def detected_technologies(detected: Column, detected_apps: Column) -> Column:
    """``array<struct<category, app, info>>`` of one page.

    The apps map gives names with comma-separated infos, the category map gives ids made of a
    name and an info. An id no app accounts for is itself the app. A list in place of the apps map
    means nothing was detected.
    """
    apps = F.map_entries(F.from_json(detected_apps, "map<string,string>", text.ANY_LENGTH))
    ids = F.flatten(
        F.transform(
            F.filter(apps, lambda a: F.length(a["value"]) > 0),
            lambda a: F.transform(
                F.split(a["value"], ","),
                lambda info: F.struct(
                    F.when(F.length(info) > 0, F.concat(a["key"], F.lit(" "), info))
                    .otherwise(a["key"])
                    .alias("id"),
                    a["key"].alias("app"),
                ),
            ),
        )
    )
    known = F.coalesce(ids, F.array().cast("array<struct<id: string, app: string>>"))
    categories = F.filter(
        F.map_entries(F.from_json(detected, "map<string,string>", text.ANY_LENGTH)), lambda c: c["value"].isNotNull()
    )

    def row(category: Column, id: Column) -> Column:
        # The last app to claim an id wins.
        app = F.try_element_at(F.filter(known, lambda k: k["id"] == id), F.lit(-1))["app"]
        rest = F.regexp_replace(F.substring(id, F.length(app) + 1, F.length(id)), r"^\s+|\s+$", "")
        return F.struct(
            category.alias("category"),
            F.coalesce(app, id).alias("app"),
            F.when(app.isNotNull(), rest).otherwise("").alias("info"),
        )

    rows = F.flatten(
        F.transform(
            categories,
            lambda c: F.transform(F.split(c["value"], ","), lambda id: row(c["key"], id)),
        )
    )
    return F.when(~F.coalesce(detected_apps.startswith("["), F.lit(False)), rows)


def _row(**values: Column) -> Column:
    """One tagged row; unnamed columns are NULL."""
    return F.struct(
        *[
            values.get(part.split()[0], F.lit(None)).cast(part.split()[1]).alias(part.split()[0])
            for part in ROW.split(", ")
        ]
    )


def fan_out(parsed: DataFrame, tables: Sequence[str] = tuple(TABLES), options: HarOptions = CURRENT) -> DataFrame:
    """Tagged rows of the wanted tables from parsed documents, in one pass.

    Rows over the size limit stay, marked ``skipped``, so they can be counted; ``table_of`` and
    the writer leave them out. Other columns of the documents (date, client) are carried along.
    """
    docs = parsed.withColumn("_reason", reject_reason())
    carried = [c for c in ("date", "client", "path") if c in parsed.columns]
    url = F.col("page_url")
    page_size = _size(F.col("payload"), options)
    if options.in_bytes:
        page_size = page_size + F.octet_length(url)
    page_fits = ~_exceeds(page_size, options)

    # First level: one row per page, report, technology and entry. Documents that give none have an empty array: a filter
    # on parsed values would move below the parse, and below the step that deals documents out, and repeat the parse.
    part = "kind: string, url: string, category: string, app: string, info: string, text: string"

    def item(kind: str, of: Column, value: Column, category=None, app=None, info=None) -> Column:
        null = F.lit(None).cast("string")
        return F.struct(
            F.lit(kind).alias("kind"), of.alias("url"),
            *[(x if x is not None else null).alias(n) for n, x in (("category", category), ("app", app), ("info", info))],
            value.alias("text"),
        ).cast(f"struct<{part}>")

    pieces = []
    if "pages" in tables:
        pieces.append(F.array(item("pages", url, F.col("payload"))))
    if "lighthouse" in tables:
        has_report = F.col("report").isNotNull() & ~F.col("report").isin("{}", "null")
        pieces.append(F.array_compact(F.array(F.when(has_report, item("lighthouse", url, F.col("report"))))))
    if "technologies" in tables:
        found = detected_technologies(F.col("detected"), F.col("detected_apps"))
        pieces.append(
            F.transform(
                F.coalesce(found, F.array().cast("array<struct<category: string, app: string, info: string>>")),
                lambda t: item("technologies", F.col("own_url"), F.lit(None), t["category"], t["app"], t["info"]),
            )
        )
    wants_entries = {"requests", "response_bodies"} & set(tables)
    if wants_entries:
        pieces.append(
            F.transform(
                F.coalesce(F.col("entries"), F.array().cast("array<string>")),
                lambda e: item("entry", url, e),
            )
        )
    none = F.array().cast(f"array<struct<{part}>>")
    # A page over the limit takes its whole document along, which is kept as it was given.
    over = F.array(item("pages", url, F.col("doc"))) if "pages" in tables else none
    source = F.col("path") if "path" in parsed.columns else F.lit(None).cast("string")
    rejected = F.array(item("rejects", source, F.col("doc"), info=F.col("_reason")))
    of_document = (
        F.when(F.col("_reason").isNotNull(), rejected if "rejects" in tables else none)
        .when(~_is_home(), none)
        .when(page_fits, F.concat(*pieces) if pieces else none)
        .otherwise(over)
    )
    items = docs.select(*carried, page_fits.alias("_fits"), F.explode(of_document).alias("i"))

    # Second level: an entry gives a request and a body.
    kind, of = F.col("i.kind"), F.col("i.url")
    rows = items
    if "lighthouse" in tables:
        report = F.when(kind == "lighthouse", F.col("i.text"))
        rows = text.drop_json_member(rows, "_report", report, "audits", "screenshot-thumbnails", "details", "items")
    if wants_entries:
        entry = F.when(kind == "entry", F.col("i.text"))
        rows = rows.withColumn("_e", F.from_json(entry, _ENTRY, text.ANY_LENGTH))
        content = F.col("_e.response.content")
        if "response_bodies" in tables:
            is_object = content.startswith("{") & F.contains(entry, F.concat(F.lit('"content":'), content))
            body = F.from_json(F.when(is_object, content), "text string", text.ANY_LENGTH)["text"]
            rows = rows.withColumn("_body", body)
        if "requests" in tables:
            rows = text.drop_json_member(rows, "_payload", entry, "response", "content", "text", require_parent=True, parent=content)

    tagged = {"pages": _row(table=F.lit("pages"), url=of, payload=F.col("i.text"), skipped=~F.col("_fits"))}
    if "lighthouse" in tables:
        size = _size(F.col("_report"), options)
        if options.in_bytes:
            size = size + F.octet_length(of)
        tagged["lighthouse"] = _row(
            table=F.lit("lighthouse"), url=of, report=F.col("_report"),
            skipped=F.coalesce(_exceeds(size, options), F.lit(True)),
        )
    if "technologies" in tables:
        tagged["technologies"] = _row(
            table=F.lit("technologies"), url=of, category=F.col("i.category"), app=F.col("i.app"),
            info=F.col("i.info"), skipped=F.lit(False),
        )
    if "rejects" in tables:
        tagged["rejects"] = _row(
            table=F.lit("rejects"), url=of, payload=F.col("i.text"), info=F.col("i.info"), skipped=F.lit(False)
        )
    choices = None
    for name in tagged:
        if name in tables:
            one = F.array(tagged[name])
            choices = F.when(kind == name, one) if choices is None else choices.when(kind == name, one)
    if wants_entries:
        from_entry = F.array_compact(F.array(*_entry_rows(of, tables, options)))
        choices = F.when(kind == "entry", from_entry) if choices is None else choices.when(kind == "entry", from_entry)
    return rows.select(*carried, F.explode(choices).alias("r")).select(*carried, "r.*")


def _entry_rows(page: Column, tables: Sequence[str], options: HarOptions) -> list[Column]:
    entry = F.col("_e")
    url = entry["_full_url"]
    if options.url_fallback:
        url = F.coalesce(url, entry["url"], F.lit(""))
    request_id = F.coalesce(entry["_request_id"], entry["_id"], entry["_raw_id"], F.lit(""))
    found = []
    if "requests" in tables:
        payload = F.col("_payload")
        # Entries without response content cannot be trimmed and are left out.
        found.append(
            F.when(
                payload.isNotNull(),
                _row(
                    table=F.lit("requests"), page=page, url=url, payload=payload, request_id=request_id,
                    skipped=_exceeds(_size(payload, options), options),
                ),
            )
        )
    if "response_bodies" in tables:
        body = F.col("_body")
        if options.max_size is None:
            cut = body
        elif options.in_bytes:
            budget = F.lit(options.max_size - 128) - F.octet_length(page) - F.octet_length(F.coalesce(url, F.lit("")))
            cut = text.fit_json_bytes(body, budget)
        else:
            cut = F.substring(body, 1, options.max_size)
        found.append(
            F.when(
                body.isNotNull(),
                _row(
                    table=F.lit("response_bodies"), page=page, url=url, body=cut,
                    truncated=F.length(cut) < F.length(body), request_id=request_id, skipped=F.lit(False),
                ),
            )
        )
        if "oversize" in tables and options.max_size is not None:
            whole = _row(
                table=F.lit("oversize"), page=page, url=url, payload=body, info=F.lit("response_bodies"), skipped=F.lit(False)
            )
            found.append(F.when(F.length(cut) < F.length(body), whole))
    return found


def settled(rows: DataFrame) -> DataFrame:
    """Tagged rows as they are stored: those over the limit belong to ``oversize``, with their table as ``info``.

    A page over the limit keeps its whole document, a request or audit its JSON.
    """
    over = F.col("skipped")
    changed = {
        "info": F.when(over, F.col("table")).otherwise(F.col("info")),
        "payload": F.when(over, F.coalesce("payload", "report")).otherwise(F.col("payload")),
        "report": F.when(~over, F.col("report")),
        "table": F.when(over, "oversize").otherwise(F.col("table")),
    }
    # An audit without a readable report is nothing to keep.
    return rows.where(~over | F.coalesce("payload", "report").isNotNull()).withColumns(changed).drop("skipped")


def table_of(rows: DataFrame, name: str, extra: Sequence[str] = ()) -> DataFrame:
    """One of the tables from tagged rows."""
    if name == "oversize":
        return settled(rows).where(F.col("table") == name).select(*TABLES[name], *extra)
    return rows.where((F.col("table") == name) & ~F.col("skipped")).select(*TABLES[name], *extra)


def tables(docs: DataFrame, options: HarOptions = CURRENT) -> dict[str, DataFrame]:
    """The tables, each computed on its own from the documents it needs."""
    parsed = parse(docs)
    return {name: table_of(fan_out(parsed, tuple(TABLES) if name == "oversize" else (name,), options), name) for name in TABLES}


COUNTERS = ("with_body", "truncated_body", "skipped_pages", "skipped_requests", "skipped_lighthouse", "rejected")


def counter_columns() -> list[Column]:
    """What the import counts: bodies, cut bodies, rows over the size limit, and documents set aside."""

    def count(condition: Column) -> Column:
        return F.count_if(condition)

    table, skipped = F.col("table"), F.col("skipped")
    return [
        count(table == "response_bodies").alias("with_body"),
        count((table == "response_bodies") & F.col("truncated")).alias("truncated_body"),
        count((table == "pages") & skipped).alias("skipped_pages"),
        count((table == "requests") & skipped).alias("skipped_requests"),
        count((table == "lighthouse") & skipped).alias("skipped_lighthouse"),
        count(table == "rejects").alias("rejected"),
    ]


def counters(rows: DataFrame) -> DataFrame:
    return rows.agg(*counter_columns())


def write_tables(
    docs: DataFrame, path: str, options: HarOptions = CURRENT, mode: str = "append", max_rows_per_file: int = 0
) -> dict[str, int]:
    """Write all tables below ``path`` in one pass; returns the counters.

    ``docs`` carries ``date`` and ``client``. ``append`` adds rows, ``overwrite`` replaces the
    (table, date, client) partitions at hand. Rejected documents and what is over a size limit go to tables
    of their own, so every home page and every broken document is in some table.
    """
    seen = Observation("har import")
    rows = fan_out(parse(docs), options=options).observe(seen, *counter_columns())
    # Rebalanced, a (table, date, client) is written by as many tasks as its size asks for, not by every task.
    (
        settled(rows)
        .drop("path")
        .hint("rebalance", "table", "date", "client")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy("table", "date", "client")
        .parquet(path)
    )
    return dict.fromkeys(COUNTERS, 0) | observed(seen)


def not_imported(docs: DataFrame, path: str) -> DataFrame:
    """Documents of releases the tables below ``path`` do not hold yet, so a repeated import adds nothing.

    The releases there are partition names, one row per date and client.
    """
    there = _releases(docs.sparkSession, path)
    return docs if there is None else docs.join(there, ["date", "client"], "left_anti")


def imported(docs: DataFrame, path: str) -> list[tuple]:
    """What ``not_imported`` leaves out: date, client and number of files of releases that are there."""
    there = _releases(docs.sparkSession, path)
    if there is None:
        return []
    left_out = docs.join(there, ["date", "client"], "left_semi").groupBy("date", "client").agg(F.count_distinct("path").alias("files"))
    return [tuple(row) for row in left_out.orderBy("date", "client").collect()]


def _releases(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path).select("date", "client").distinct() if exists(spark, path) else None


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One written table, with its date and client."""
    rows = spark.read.parquet(path).where(F.col("table") == name)
    return rows.select(*TABLES[name], "date", "client")
