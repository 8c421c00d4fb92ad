import datetime as dt

import pytest
from crawl import page, request, rum, summary, tables

from sitepulse.plans import reports
from sitepulse.session import scratch_path

DAYS = [dt.date(2023, month, 1) for month in (5, 6, 7)]


@pytest.fixture
def crawl(spark):
    pages, requests = [], []
    for i, day in enumerate(DAYS):
        for client in ("desktop", "mobile"):
            for root in (True, False):
                for k in range(3 + i):
                    pages.append(page(f"https://s{k}.example/", client, day, root, 1000 * 10 ** (k % 2), {"bytesCss": 1000 * k + 1},
                                      technologies=["Drupal"] if k else None))
                    requests.append(request(f"https://s{k}.example/", client, day, root, 1000 * 10 ** (k % 2)))
    users = [rum("https://s1.example", month=202305, fcp=[(0, 300, 1.0)])]
    sums = [summary("https://s1.example", month=m, fast_ol=1, avg_ol=0, slow_ol=0) for m in (202305, 202306)]
    return tables(spark, pages, requests, users, sums)


@pytest.fixture
def store(spark):
    return reports.ReportStore(spark, scratch_path(spark, "test-store"))


def rows(table):
    return sorted(map(str, table.collect()))


def test_incremental_equals_full(spark, crawl, store):
    for date in ("2023_05_01", "2023_06_01", None):
        for pattern in ("numUrls", "bytesCss", "h2", "cruxFastOl"):
            reports.run_series(crawl, store, date, "ALL", pattern)
    full = reports.ReportStore(spark, scratch_path(spark, "test-store"))
    for pattern in ("numUrls", "bytesCss", "h2", "cruxFastOl"):
        reports.run_series(crawl, full, None, "ALL", pattern)
    assert rows(store.series()) == rows(full.series())
    assert store.series().select("lens").distinct().count() > 4


def test_up_to_date_series_is_skipped_unless_forced(crawl, store):
    assert reports.run_series(crawl, store, "2023_06_01", pattern="numUrls")
    assert reports.run_series(crawl, store, "2023_06_01", pattern="numUrls") == []
    assert reports.run_series(crawl, store, "2023_05_01", pattern="numUrls", force=True)
    assert store.last_dates() == {("base", "numUrls"): "2023_05_01"}


def test_histograms_refuse_incomplete_crawls(spark, crawl, store):
    with pytest.raises(reports.NotReady):
        reports.run_histograms(crawl, store, "2023_08_01", pattern="bytesCss")
    lame = tables(spark, [page(date=DAYS[0])], [request(date=DAYS[0])])
    missing = reports.missing_slices(lame, "2023-05-01")
    assert len(missing) == 6 and ("pages", "desktop", False) in missing and ("requests", "mobile", True) in missing


def test_histograms_skip_existing(crawl, store):
    first = reports.run_histograms(crawl, store, "2023_05_01", "top1k", "bytes*")
    assert len(first) == 8
    again = reports.run_histograms(crawl, store, "2023_05_01", "ALL", "bytesCss")
    assert ("top1k", "bytesCss") not in again and ("base", "bytesCss") in again
    assert len(reports.run_histograms(crawl, store, "2023_05_01", "top1k", "bytesCss", force=True)) == 1
    found = store.histograms()
    assert found.count() == found.dropDuplicates(["lens", "metric", "date", "client", "bin"]).count()


def test_nothing_asked(crawl, store):
    with pytest.raises(ValueError):
        reports.run_reports(crawl, store)


def test_delete_dry_run_and_last_date(crawl, store):
    reports.run_series(crawl, store, "2023_05_01", pattern="numUrls")
    left = reports.delete_date(store, "2023_05_01", pattern="num*", dry_run=True)
    assert left.count() == 0 and store.series().count() == 2
    assert reports.delete_date(store, "2023_05_01", lens="top1k").count() == 2
    assert reports.delete_date(store, "2023_05_01").count() == 0
    # An emptied series starts over.
    reports.run_series(crawl, store, "2023_06_01", pattern="numUrls")
    assert store.series().count() == 4


def test_backfill_and_dates(crawl, store):
    assert [r.date for r in reports.list_dates(crawl.pages, "2023_05_15").collect()] == ["2023_07_01", "2023_06_01"]
    reports.backfill(crawl, store, ["2023_05_01", "2023_06_01"], "ALL", "bytesCss")
    assert store.histograms().select("date").distinct().count() == 2
    with pytest.raises(reports.NotReady):
        reports.backfill(crawl, store, ["2023_09_01"])
    assert reports.add_date(["2023_05_01"], "2023_06_01") == ["2023_06_01", "2023_05_01"]


def test_dates_reached_without_rows(crawl, store):
    """A series that has no row is not computed from the start again; a deletion starts it over."""
    reports.run_series(crawl, store, "2023_05_01", pattern="hreflang")
    reached = store.last_dates()
    assert reached[("base", "hreflang")] == "2023_05_01"
    assert reports.plan_series(reached, "2023_05_01", None, "hreflang", False) == {}
    assert list(reports.plan_series(reached, "2023_06_01", None, "hreflang", False)) == ["2023_05_01"]
    reports.delete_date(store, "2023_05_01", pattern="hreflang")
    assert list(reports.plan_series(store.last_dates(), "2023_06_01", None, "hreflang", False)) == [None]


def test_export(spark, crawl, store):
    reports.run_series(crawl, store, None, None, "bytesCss")
    reports.run_histograms(crawl, store, "2023_05_01", None, "bytesCss")
    path = scratch_path(spark, "test-export")
    reports.export_series(store, f"{path}/series")
    reports.export_histograms(store, f"{path}/histograms", "2023_05_01")
    assert "percent" not in spark.read.json(f"{path}/series").columns
    assert spark.read.json(f"{path}/histograms/lens=base/date=2023_05_01/metric=bytesCss").count() == store.histograms().count()


def test_json_array_report(spark):
    path = scratch_path(spark, "test-array")
    spark.createDataFrame([('[{"date": "2023_05_01", "urls": 3},\n {"date": "2023_04_01", "urls": 2}]',)], "value string").coalesce(1).write.text(path)
    found = reports.read_json_report(spark, path, "date string, urls bigint").agg({"date": "max"}).first()[0]
    assert found == "2023_05_01"


def test_untouched_dates_keep_their_files(spark, crawl, store):
    from pathlib import Path

    def files():
        return {str(p) for p in Path(store.root.removeprefix("file:").replace("//", "/")).glob("series/date=*/*.parquet")}

    reports.run_series(crawl, store, "2023_06_01", pattern="numUrls")
    before = files()
    reports.run_series(crawl, store, "2023_07_01", pattern="numUrls")
    after = files()
    assert len(before) == 2 and before < after and len(after) == 3
    reports.delete_date(store, "2023_06_01")
    left = files()
    assert len(left) == 2 and left < after
    assert store.last_dates() == {("base", "numUrls"): "2023_07_01"}


def test_array_reports_replace_a_series(spark, crawl, store):
    reports.run_series(crawl, store, pattern="numUrls")
    path = scratch_path(spark, "test-array")
    spark.createDataFrame([('[{"date": "2023_01_01", "client": "desktop"},\n {"date": "2023_02_01", "client": "desktop"}]',)], "value string").coalesce(1).write.text(path)
    reports.import_series(store, path, "base", "numUrls")
    assert sorted(r.date for r in store.series().collect()) == ["2023_01_01", "2023_02_01"]
    assert store.last_dates() == {("base", "numUrls"): "2023_02_01"}
