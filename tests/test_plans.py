"""What the optimiser makes of the reports on partitioned tables."""

import re

import pytest
from crawl import page, request, rum, tables

from sitepulse.plans import facts, histograms, lens, metrics as m, series
from sitepulse.plans.tables import CrawlTables
from sitepulse.session import scratch_path


@pytest.fixture(scope="module")
def stored(spark):
    root = scratch_path(spark, "test-plans")
    made = tables(spark, [page()], [request()], [rum(fcp=[(0, 1, 1.0)])])
    made.pages.write.partitionBy("date", "client").parquet(f"{root}/pages")
    made.requests.write.partitionBy("date", "client").parquet(f"{root}/requests")
    made.rum.write.partitionBy("yyyymm").parquet(f"{root}/rum")
    made.rum_summary.write.parquet(f"{root}/rum_summary")
    return CrawlTables.read(spark, root)


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def schemas(text):
    return re.findall(r"ReadSchema: struct<(.*)>", text)


def test_one_report_reads_one_partition_and_one_document_column(stored):
    text = plan(histograms.report(stored, "bytesCss", "2023-05-01"))
    assert re.search(r"PartitionFilters: \[.*date#\d+ = 2023-05-01", text)
    assert schemas(text) == ["is_root_page:boolean,summary:string"]
    assert text.count("Scan parquet") >= 1


def test_documents_are_parsed_once_for_many_facts(stored):
    rows = facts.page_facts(stored.pages, ["bytesCss", "bytesJS", "speed_index", "bootup_ms", "offscreen_bytes"])
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 3


def test_typed_facts_need_no_documents(spark, stored):
    path = scratch_path(spark, "test-facts")
    facts.write_page_facts(stored.pages, path)
    typed = CrawlTables(pages=spark.read.parquet(path))
    text = plan(histograms.report(typed, "bytesCss", "2023-05-01"))
    assert schemas(text) == ["is_root_page:boolean,bytesCss:double"] and "from_json" not in text


def test_real_user_scan_is_pruned_to_the_metric(stored):
    text = plan(histograms.report(stored, "cruxFcp", "2023-05-01"))
    (read,) = schemas(text)
    assert "first_contentful_paint" in read and "onload" not in read and "origin" not in read
    assert re.search(r"PartitionFilters: \[.*yyyymm#\d+ = 202305", text)


def test_requests_shuffle_once_before_the_join(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(series.series(stored, list(m.REQUEST_SHARES), lens.select("ALL")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Requests, pages and the final sum: three exchanges in all.
    assert text.split("(1) Scan")[0].count("- Exchange") == 3
    assert "url:string" in text and "payload" not in " ".join(schemas(text))


def test_all_lenses_share_one_scan(stored):
    text = plan(histograms.crawl_histograms(stored, [m.HISTOGRAMS["bytesCss"], m.HISTOGRAMS["tcp"]], lens.select("ALL")))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_facts_are_written_by_size_not_by_split(spark, stored):
    pages = stored.pages.crossJoin(spark.range(60)).drop("id").repartition(6)
    path = scratch_path(spark, "test-facts-files")
    facts.write_page_facts(pages, path)
    written = spark.read.parquet(path)
    # Six tasks have rows of the one date and client; one share of them is written, and sorted, by one task.
    assert written.count() == 60 and len(written.inputFiles()) == 1
