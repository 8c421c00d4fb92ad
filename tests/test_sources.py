import pytest
from pyspark.sql import functions as F

from sitepulse.operators import directory
from sitepulse.session import scratch_path
from sitepulse.sources import csvdump, listings, release, schemas


def dump(spark, *lines):
    path = scratch_path(spark, "test-csv")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.option("compression", "gzip").text(path)
    return path


SCHEMA = "id bigint, name string, ok boolean, n double"


def test_dump_is_cleaned(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    path = dump(spark, r'1,"a \"b\" c",1,\N', r"2,\N,0,2.5", '3,"x\\\ny",,"7"', r'4,"",true,""')
    rows = [tuple(r) for r in csvdump.load_dump(spark, path, schema).orderBy("id").collect()]
    assert rows == [(1, 'a "b" c', True, None), (2, "", False, 2.5), (3, "x, y", None, 7.0), (4, "", True, None)]


def test_bad_row_limit(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    good = [f"{i},a,1,1" for i in range(30)]
    bad = ["x,a,1,1", "1,a,1", "1,a,maybe,1", "1,a,1,1,1"]
    ten = [bad[i % 4] for i in range(10)]
    assert csvdump.load_dump(spark, dump(spark, *good, *ten), schema).count() == 30
    with pytest.raises(csvdump.TooManyBadRows):
        csvdump.load_dump(spark, dump(spark, *good, *ten, bad[0]), schema)


def test_archive_is_loaded_once(spark):
    def line(schema, **values):
        return ",".join(str(values.get(f.name, r"\N")) for f in schema)

    pages = dump(spark, line(schemas.SUMMARY_PAGES, pageid=1, url='"http://a/"', _adult_site=0, reqTotal=7))
    requests = dump(spark, line(schemas.SUMMARY_REQUESTS, requestid=1, pageid=1, firstReq=1))
    target = scratch_path(spark, "test-archive")
    assert csvdump.load_archive(spark, "mobile_Dec_15_2018", pages, requests, target) == {"summary_pages": True, "summary_requests": True}
    assert not any(csvdump.load_archive(spark, "mobile_Dec_15_2018", pages, requests, target).values())
    row = spark.read.parquet(f"{target}/summary_pages").first()
    assert (row.pageid, row.url, row._adult_site, row.reqTotal, str(row.date), row.client, row.label) == (1, "http://a/", False, 7, "2018-12-15", "mobile", "")
    assert len(schemas.SUMMARY_PAGES) == 88 and len(schemas.SUMMARY_REQUESTS) == 61


def test_first_of_each(spark):
    rows = spark.createDataFrame([(3, "k", "c"), (1, "k", "a"), (2, "j", "b")], "id int, key string, v string")
    assert sorted(r.v for r in csvdump.first_of_each(rows, ("key",), "id").collect()) == ["a", "b"]
    nulls = spark.createDataFrame([(2, None), (1, None), (3, "k")], "id int, key string")
    assert sorted(r.id for r in csvdump.first_of_each(nulls, ("key",), "id").collect()) == [1, 3]
    plan = csvdump.first_of_each(rows, ("key",), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("WindowGroupLimit") >= 2 and "Join" not in plan


def test_release_names(spark):
    def parts(name):
        r = F.lit(name)
        row = spark.range(1).select(release.release_date(r), release.release_client(r), release.release_client(r, strict=False)).first()
        return str(row[0]), row[1], row[2]

    assert parts("chrome-Mar_01_2020") == ("2020-03-01", "desktop", "desktop")
    assert parts("android-Dec_9_2019") == ("2019-12-09", "mobile", "mobile")
    assert parts("ios-Dec_9_2019") == ("2019-12-09", "ios", "mobile")


DIRECTORY = """<?xml version="1.0"?>
<RDF xmlns:d="http://purl.org/dc/elements/1.0/">
<Topic r:id="Top"/>
<ExternalPage about="http://www.a.com/"><d:Title>First</d:Title><d:Description>D &amp; d</d:Description><topic>T1</topic></ExternalPage>
<ExternalPage about="http://a.com/">
  <d:Title>Second</d:Title>
  <topic>T2</topic></ExternalPage>
<ExternalPage about="http://sub.a.com/"><d:Title>No</d:Title><topic>T3</topic></ExternalPage>
<ExternalPage about="http://a.com/deep"><d:Title>No</d:Title><topic>T4</topic></ExternalPage>
<ExternalPage about="http://a.com/?q"><d:Title>No</d:Title><topic>T5</topic></ExternalPage>
<ExternalPage about="http://b.co.uk/"><topic>T6</topic></ExternalPage>
</RDF>"""


def test_directory_join(spark, tmp_path):
    (tmp_path / "d.rdf").write_text(DIRECTORY)
    (tmp_path / "r.csv").write_text("0,a.com\n1,a.com\n2,b.co.uk\n3,c.org\n")
    entries = listings.read_directory(spark, str(tmp_path / "d.rdf"))
    ranked = listings.read_ranked_domains(spark, str(tmp_path / "r.csv"))
    rows = [tuple(r) for r in directory.ranked_directory(ranked, entries).orderBy("alexa_rank").collect()]
    assert rows == [
        ("a.com", 1, 0, ["T1", "T2"], "http://www.a.com/", "First", "D & d"), ("b.co.uk", 2, 0, ["T6"], "http://b.co.uk/", "", ""),
        ("c.org", 3, 0, [], None, None, None),
    ]
    names = directory.ranked_directory(ranked, entries).drop("part").schema.fieldNames()
    assert names == schemas.RANKED_URLS.fieldNames()


def test_hot_domain_is_split_and_whole(spark):
    entries = spark.range(5000).select(
        F.col("id").alias("position"), F.lit("http://hot.com/").alias("url"), F.lit("t").alias("title"),
        F.lit("").alias("description"), F.col("id").cast("string").alias("topic"),
    )
    ranked = spark.createDataFrame([(1, "hot.com")], "alexa_rank int, alexa_domain string")
    rows = directory.ranked_directory(ranked, entries, topics_per_row=1000).collect()
    assert len(rows) == 5 and sorted(int(t) for r in rows for t in r.dmoz_topic) == list(range(5000))
    both = entries.union(spark.createDataFrame([(9000, "http://rare.com/", "r", "", "x"), (8000, "http://rare.com/", "q", "", "y")], entries.schema))
    ranked = spark.createDataFrame([(1, "hot.com"), (2, "rare.com"), (3, "none.com")], "alexa_rank int, alexa_domain string")
    rows = directory.ranked_directory(ranked, both, topics_per_row=1000).collect()
    assert [(r.part, r.dmoz_topic, r.dmoz_title) for r in rows if r.alexa_domain == "rare.com"] == [(0, ["y", "x"], "q")]
    assert len(rows) == 7 and {r.dmoz_title for r in rows if r.alexa_domain == "hot.com"} == {"t"}


def test_json_lines(spark):
    source, target = scratch_path(spark, "test-json"), scratch_path(spark, "test-table")
    listings.write_json_lines(spark.createDataFrame([(1, None), (2, ["a"])], "x int, y array<string>"), source)
    rows = listings.load_json_lines(spark, source, target, "x bigint, y array<string>")
    assert sorted(map(tuple, rows.collect()), key=lambda r: r[0]) == [(1, None), (2, ["a"])]


def test_continued_rows_cross_blocks(spark):
    """Plain files read in tiny blocks: rows broken once, twice, and at the end."""
    lines = [f"{i},a{i}\\\nb{i},{i % 2}" if i % 3 else f"{i},x\\\ny\\\nz" for i in range(400)] + ["999,last\\"]
    path = scratch_path(spark, "test-blocks")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 64)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = sorted(r.value for r in csvdump.read_records(spark, path).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == sorted(line.replace("\\\n", ", ").replace("last\\", "last, ") for line in lines)


def test_bad_rows_are_kept(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    kept = scratch_path(spark, "test-rejects")
    rows = csvdump.load_dump(spark, dump(spark, "1,a,1,1", "x,a,1,1", "1,a,1"), schema, rejects=kept)
    assert rows.count() == 1
    assert sorted(r.line for r in spark.read.parquet(kept).collect()) == ["1,a,1", "x,a,1,1"]
    path = dump(spark, "1,a,1,1", "y,a,1,1")
    csvdump.load_dump(spark, path, schema)
    assert [r.line for r in spark.read.parquet(csvdump.rejects_path(spark)).where(F.col("source") == path).collect()] == ["y,a,1,1"]
