import gzip
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from contract import etl
from sitepulse.sources import har


def docs(spark, *documents):
    lines = [(d if isinstance(d, str) else json.dumps(d, ensure_ascii=False), "/crawls/chrome-Mar_1_2020/f") for d in documents]
    return spark.createDataFrame(lines, "doc string, path string")


def document(page=None, entries=(), **more):
    return {"log": {"pages": [{"_URL": "http://a/", **(page or {})}], "entries": list(entries)}, **more}


def rows(spark, name, *documents, options=har.CURRENT):
    return [tuple(r) for r in har.tables(docs(spark, *documents), options)[name].collect()]


def test_page_url_and_payload(spark):
    tested = document({"_metadata": {"tested_url": "http://t/"}, "x": 1.0, "k": "é"})
    ((url, payload),) = rows(spark, "pages", tested)
    assert url == "http://t/"
    assert payload == '{"_URL":"http://a/","_metadata":{"tested_url":"http://t/"},"x":1.0,"k":"é"}'


@pytest.mark.parametrize("depth, kept", [("0", 1), ("", 1), (0, 1), ("1", 0), (2, 0)])
def test_only_home_pages(spark, depth, kept):
    assert len(rows(spark, "pages", document({"_metadata": {"crawl_depth": depth}}))) == kept


def test_entries(spark):
    entries = [
        {"_full_url": "http://a/1", "response": {"content": {"text": "a\"é\n", "size": 3}, "n": 1.50}},
        {"url": "http://a/2", "response": {"content": {"text": ""}}},
        {"_full_url": "http://a/3", "response": {}},
        {"_full_url": "http://a/4"},
    ]
    requests = rows(spark, "requests", document(entries=entries))
    assert requests == [
        ("http://a/", "http://a/1", '{"_full_url":"http://a/1","response":{"content":{"size":3},"n":1.5}}'),
        ("http://a/", None, '{"url":"http://a/2","response":{"content":{}}}'),
    ]
    assert rows(spark, "response_bodies", document(entries=entries)) == [
        ("http://a/", "http://a/1", 'a"é\n', False, ""), ("http://a/", None, "", False, "")]
    legacy = rows(spark, "requests", document(entries=entries), options=har.LEGACY)
    assert legacy[1][1] == "http://a/2"


def test_size_limits(spark):
    small = har.HarOptions(max_size=60)
    long_body = {"_full_url": "u", "response": {"content": {"text": "é" * 100}}}
    long_request = {"_full_url": "u" * 60, "response": {"content": {}}}
    doc = document(entries=[long_body, long_request])
    assert rows(spark, "response_bodies", doc, options=small) == [("http://a/", "u", "é" * 60, True, "")]
    assert [r[1] for r in rows(spark, "requests", doc, options=small)] == ["u"]
    # An oversize page takes its document with it.
    big = document({"pad": "x" * 60}, [long_body])
    assert rows(spark, "pages", big, options=small) == rows(spark, "requests", big, options=small) == []
    counted = har.counters(har.fan_out(har.parse(docs(spark, doc, big)), options=small)).first().asDict()
    assert counted == {"with_body": 1, "truncated_body": 1, "skipped_pages": 1, "skipped_requests": 1, "skipped_lighthouse": 0, "rejected": 0}


def test_what_a_limit_cuts_is_kept(spark):
    small = har.HarOptions(max_size=60)
    long_body = {"_full_url": "u", "response": {"content": {"text": "é" * 100}}}
    long_request = {"_full_url": "u" * 60, "response": {"content": {}}}
    doc, big = document(entries=[long_body, long_request]), document({"pad": "x" * 60}, [long_body])
    over = {r[3]: r for r in rows(spark, "oversize", doc, big, options=small)}
    assert over["response_bodies"][2] == "é" * 100
    assert json.loads(over["requests"][2])["_full_url"] == "u" * 60
    assert json.loads(over["pages"][2]) == big
    # Without a limit nothing is cut, and no string is too long to be read.
    (body,) = rows(spark, "response_bodies", document(entries=[{"_full_url": "u", "response": {"content": {"text": "b" * 20_000_001}}}]))
    assert len(body[2]) == 20_000_001 and not body[3]
    assert rows(spark, "oversize", doc, big) == []


def test_body_cut_in_bytes(spark):
    options = har.HarOptions(max_size=128 + 9 + 1 + 10, in_bytes=True)
    entry = {"_full_url": "u", "response": {"content": {"text": 'é"aaaaaaaa'}}}
    small_page = document(entries=[entry])
    ((_, _, body, cut, _),) = rows(spark, "response_bodies", small_page, options=options)
    assert (body, cut) == ('é"aaaaa', True)  # 2 + 3 + 5 bytes


def test_technologies(spark):
    page = {"_detected": {"CMS": "WordPress 5.1,Unknown 2", "Lang": "PHP", "Db": "My SQL 8"},
            "_detected_apps": {"WordPress": "5.1", "PHP": "", "My": "SQL 8", "My SQL": "8"}}
    found = {r[1:] for r in rows(spark, "technologies", document({**page, "_metadata": {"tested_url": "http://t/"}}))}
    # The later of two apps that claim an id wins; unknown ids stand for themselves.
    assert found == {("CMS", "WordPress", "5.1"), ("CMS", "Unknown 2", ""), ("Lang", "PHP", ""), ("Db", "My SQL", "8")}
    assert rows(spark, "technologies", document({**page, "_detected_apps": []})) == []
    assert len(rows(spark, "technologies", document({"_detected": {"CMS": "A,B"}}))) == 2
    # This table keeps the page's own address.
    assert rows(spark, "technologies", document({"_detected": {"C": "A"}, "_metadata": {"tested_url": "http://t/"}}))[0][0] == "http://a/"


def test_lighthouse(spark):
    report = {"audits": {"screenshot-thumbnails": {"details": {"items": [1], "type": "x"}}, "b": 1}}
    found = rows(spark, "lighthouse", document(_lighthouse=report), document(_lighthouse={}), document(), document(_lighthouse={"audits": {}}))
    assert [r[1] for r in found] == ['{"audits":{"screenshot-thumbnails":{"details":{"type":"x"}},"b":1}}', '{"audits":{}}']


def test_rejects(spark):
    found = har.rejects(docs(spark, "{bad", {"log": {"pages": [], "entries": []}}, {"log": {"pages": [{"x": 1}]}}, document()))
    assert sorted(r.reason for r in found.collect()) == ["no page", "no url", "unparsable"]
    long = {"log": {"pages": [{"x": "y" * 20_000_001}]}}
    assert [r.reason for r in har.rejects(docs(spark, long)).collect()] == ["no url"]
    stored = rows(spark, "rejects", "{bad", document())
    assert stored == [("/crawls/chrome-Mar_1_2020/f", "{bad", "unparsable")]


def test_written_once_and_read_back(spark, tmp_path):
    source = har.with_release(docs(spark, document(entries=[{"_full_url": "u", "response": {"content": {"text": "b"}}}])))
    path = str(tmp_path / "har")
    assert har.write_tables(source, path)["with_body"] == 1
    har.write_tables(source, path)
    assert har.read_table(spark, path, "pages").count() == 2
    har.write_tables(source, path, mode="overwrite")
    (row,) = har.read_table(spark, path, "response_bodies").collect()
    assert (row.body, str(row.date), row.client) == ("b", "2020-03-01", "desktop")


def test_each_document_is_scanned_once(spark, tmp_path):
    docs(spark, document()).write.parquet(str(tmp_path / "docs"))
    rows_ = har.fan_out(har.parse(spark.read.parquet(str(tmp_path / "docs"))))
    plan = rows_._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan
    assert rows_.where(F.col("table") == "pages").count() == 1


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    from sitepulse.streaming import ingest

    lines = docs(spark, document(entries=[{"_full_url": "u", "response": {"content": {"text": "b"}}}]), "{bad")
    target = str(tmp_path / "ingested")
    for _ in range(2):
        assert ingest.write_batch(lines, target, "c-0")["with_body"] == 1
    assert ingest.write_batch(lines, target, "c-1")["rejected"] == 1
    assert har.read_table(spark, target, "response_bodies").count() == 2
    assert spark.read.parquet(target).where("table = 'pages'").select("batch").distinct().count() == 2


def test_ingest_counts_and_archives(spark, tmp_path):
    from sitepulse.streaming import ingest

    source, archive = tmp_path / "in" / "chrome-Mar_1_2020", tmp_path / "done"
    for n in range(3):
        source.mkdir(parents=True, exist_ok=True)
        (source / f"{n}.json").write_text(json.dumps(document(entries=[{"_full_url": f"u{n}", "response": {"content": {"text": "b"}}}])) + "\n")
        found = ingest.ingest_hars(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"), archive=str(archive))
        assert found["with_body"] == 1
    assert har.read_table(spark, str(tmp_path / "t"), "pages").count() == 3
    assert ingest.ingest_hars(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")) == {}


def test_documents_are_parsed_once_above_where_they_are_dealt(spark):
    given = docs(spark, document(), document({"_metadata": {"crawl_depth": "1"}}), "{bad").repartition(3)
    plans = {name: table for name, table in har.tables(given).items()} | {"all": har.fan_out(har.parse(given)), "reasons": har.rejects(given)}
    for name, table in plans.items():
        text = table._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("from_json(StructField(log") == 1, name
        assert text.index("from_json(StructField(log") < text.index("Repartition"), name


def test_only_the_marked_body_is_large(spark, tmp_path):
    pages = [(1, "http://a/", "x"), (2, "http://b/", "@large@"), (3, "http://c/", "a @large@ b"), (None, "http://d/", "@large@")]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    bodies = har.tables(etl.large_hars(spark, str(tmp_path)))["response_bodies"].where("body <> ''")
    found = {(r.page, r.n, r.start) for r in bodies.selectExpr("page", "length(body) AS n", "left(body, 12) AS start").collect()}
    assert found == {("http://a/", 21_000_000, "012345678901"), ("http://c/#tested", 11, "a @large@ b"), ("http://d/", 7, "@large@")}


def test_tasks_grow_in_number_with_files_not_in_length(spark, tmp_path):
    pages = spark.range(100).selectExpr("id AS page_id", "'http://' || id AS url", "'x' AS html").coalesce(1)
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    written = etl.hars(spark, str(tmp_path), 9).select("doc")
    assert written.rdd.getNumPartitions() == 12
    written.write.option("compression", "gzip").option("maxRecordsPerFile", 1).text(f"{tmp_path}/files")
    # Files come in several splits, which are kept; only fewer splits are dealt out.
    splits = har.read_files(spark, f"{tmp_path}/files/*.gz").rdd.getNumPartitions()
    assert splits > 2 and har.read_files(spark, f"{tmp_path}/files/*.gz", partitions=2).rdd.getNumPartitions() == splits
    assert har.read_files(spark, f"{tmp_path}/files/*.gz", partitions=50).rdd.getNumPartitions() == 50
    assert har.read_files(spark, f"{tmp_path}/files/*.gz", partitions=2).count() == 100


def test_whole_files_are_listed_by_folder_and_read_to_the_byte(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    for i in range(40):
        (tmp_path / "a" / f"{i:02d}.gz").write_bytes(gzip.compress(b"one %d\n" % i) + gzip.compress(b"\xff two\n"))
    (tmp_path / "b" / "0.gz").write_bytes(gzip.compress(b""))
    (tmp_path / "b" / "0.txt").write_bytes(b"plain")
    (tmp_path / "0.gz").write_bytes(gzip.compress(b"top"))

    def rows(docs):
        return sorted((r.path, bytes(r.doc)) for r in docs.selectExpr("path", "CAST(doc AS BINARY) AS doc").collect())

    # Folders that hold folders, and what finds them, are left to the glob.
    for glob in ("a/*.gz", "a/[0-2]*.gz", "*/*.gz", "*/0*", "[ab]/0.{gz,txt}", "{a,b/0.}*", "*", "*.gz", "a/07.gz", "a/*"):
        given = spark.read.text(f"{tmp_path}/{glob}", wholetext=True).selectExpr("_metadata.file_path AS path", "value AS doc")
        found = rows(har.read_files(spark, f"{tmp_path}/{glob}"))
        assert found == rows(given) and found
    for glob in ("a/*.zip", "c/*.gz"):
        with pytest.raises(AnalysisException):
            har.read_files(spark, f"{tmp_path}/{glob}")
    # Files found by a glob were each a path of their own, listed by a job with a task for each.
    spark.sparkContext.setJobGroup("listing", "whole files")
    try:
        har.read_files(spark, f"{tmp_path}/a/*.gz")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("listing")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_small_files_share_a_task(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    for i in range(4 * cores + 9):
        (tmp_path / f"{i}.gz").write_bytes(gzip.compress(b"%d" % i))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        docs = har.read_files(spark, f"{tmp_path}/*.gz")
        assert docs.rdd.getNumPartitions() == 4 * cores
        assert har.read_files(spark, f"{tmp_path}/*.gz", partitions=4 * cores + 3).rdd.getNumPartitions() == 4 * cores + 3
        assert sorted(int(r.doc) for r in docs.collect()) == list(range(4 * cores + 9))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_every_document_is_written_once_to_a_file_of_its_own(spark, tmp_path):
    docs = spark.createDataFrame([("a",), ("b\nc",), (None,), ("ü" * 9,)], "doc string").repartition(3)
    for _ in range(2):
        # The second run stands for a repeated task.
        glob = etl._written_each(docs, f"{tmp_path}/files")
        files = [f for f in (tmp_path / "files").rglob("*") if f.is_file()]
        assert sorted(gzip.decompress(f.read_bytes()).decode() for f in files) == ["\n", "a\n", "b\nc\n", "ü" * 9 + "\n"]
    assert sorted(r.doc for r in har.read_files(spark, glob).collect()) == ["\n", "a\n", "b\nc\n", "ü" * 9 + "\n"]


def test_whole_files_of_no_pages(spark, tmp_path):
    spark.range(0).selectExpr("id AS page_id", "'http://' || id AS url", "'x' AS html").write.parquet(f"{tmp_path}/pages.parquet")
    assert etl.har_whole_files(spark, str(tmp_path)).count() == 0
