import json

import pytest
from crawl import page, request, rum, summary, tables

from sitepulse.__main__ import main
from sitepulse.plans.reports import ReportStore
from sitepulse.session import scratch_path
from sitepulse.sources import har


def test_report_jobs(spark, capsys):
    root = scratch_path(spark, "test-jobs")
    slices = [(c, r) for c in ("desktop", "mobile") for r in (True, False)]
    made = tables(
        spark, [page(client=c, root=r, summary={"bytesCss": 5}) for c, r in slices], [request(client=c, root=r) for c, r in slices],
        [rum(fcp=[(0, 100, 1.0)])], [summary(fast_ol=1, avg_ol=0, slow_ol=0)],
    )
    made.pages.write.partitionBy("date", "client").parquet(f"{root}/t/pages")
    made.requests.write.partitionBy("date", "client").parquet(f"{root}/t/requests")
    made.rum.write.partitionBy("yyyymm").parquet(f"{root}/t/rum")
    made.rum_summary.write.parquet(f"{root}/t/rum_summary")
    io = ["--tables", f"{root}/t", "--store", f"{root}/s"]
    main(["reports", *io, "--histograms", "2023_05_01", "--timeseries", "--reports", "*Css", "--export", f"{root}/e"], spark)
    main(["dates", "--tables", f"{root}/t"], spark)
    main(["delete-date", "--store", f"{root}/s", "--date", "2023_05_01", "--dry-run"], spark)
    out = capsys.readouterr().out
    assert "histograms: 2 reports" in out and "2023_05_01" in out and "0 rows left" in out
    assert ReportStore(spark, f"{root}/s").series().count() == 2
    assert spark.read.json(f"{root}/e/timeseries").count() == 2


def test_import_jobs(spark, capsys):
    root = scratch_path(spark, "test-jobs")
    doc = json.dumps({"log": {"pages": [{"_URL": "http://a/"}], "entries": []}})
    spark.createDataFrame([(doc,)], "value string").write.text(f"{root}/in/chrome-Mar_1_2020")
    for _ in range(2):  # the second run finds the release there
        main(["import-har", "--source", f"{root}/in/*", "--target", f"{root}/a"], spark)
    with pytest.raises(SystemExit):
        main(["import-har", "--source", f"{root}/in/*", "--target", f"{root}/a", "--marker", f"{root}/done"], spark)
    main(["ingest-har", "--source", f"{root}/in", "--target", f"{root}/b", "--checkpoint", f"{root}/c"], spark)
    for target in ("a", "b"):
        assert [r.url for r in har.read_table(spark, f"{root}/{target}", "pages").collect()] == ["http://a/"]
