from decimal import Decimal

import pytest
from crawl import page, request, rum, tables

from sitepulse.plans import histograms, lens, metrics as m


def report(spark, name, lens_name=None, date="2023-05-01", **rows):
    return [tuple(r) for r in histograms.report(tables(spark, **rows), name, date, lens_name).collect()]


def test_bins_density_and_null_bin(spark):
    pages = [page(summary={"bytesCss": v}) for v in (0, 10239, 10240, 30000)] + [page(), page(summary={"bytesCss": "7"})]
    pages += [page(summary={"bytesCss": 1}, root=False), page(summary={"bytesCss": 1}, client="mobile")]
    rows = report(spark, "bytesCss", pages=pages)
    # A missing member and a member of the wrong type share the NULL bin, which comes first.
    assert [(r[0], r[1], r[2]) for r in rows] == [
        ("desktop", 2, None), ("desktop", 2, 0), ("mobile", 1, 0), ("desktop", 1, 10), ("desktop", 1, 20),
    ]
    desktop = [r for r in rows if r[0] == "desktop"]
    assert sum(r[3] for r in desktop) == pytest.approx(1)
    assert [r[4] for r in desktop] == pytest.approx([2 / 6, 4 / 6, 5 / 6, 1])


def test_having_and_dotted_key(spark):
    pages = [page(payload={"_cpu.v8.compile": v}) for v in (5, 5.0, -3, 2.5, None)]
    assert [r[:3] for r in report(spark, "compileJs", pages=pages)] == [("desktop", 2, 5)]


def test_fallback_chain_and_floor(spark):
    new = {"audits": {"interactive": {"numericValue": 3500}}}
    middle = {"audits": {"interactive": {"rawValue": 9000}, "consistently-interactive": {"rawValue": 5000}}}
    pages = [page(lighthouse=new), page(lighthouse=middle), page(lighthouse="{}"), page()]
    assert [r[2] for r in report(spark, "ttci", pages=pages)] == [3, 5]
    import datetime as dt

    old = [page(lighthouse=new, date=dt.date(2022, 2, 1))]
    assert report(spark, "ttci", date="2022-02-01", pages=old) == []


def test_request_join_needs_all_keys(spark):
    pages = [page(), page(), page("https://b.example/", rank=None)]
    requests = [request(payload={"_cpu.EvaluateScript": v}) for v in (9, 10, 31, -50)]
    requests += [request("https://b.example/", rank=None, payload={"_cpu.EvaluateScript": 100})]
    rows = report(spark, "evalJs", pages=pages, requests=requests)
    # Rounded half up to steps of 20, doubled by the duplicate page, no NULL ranks, no negatives.
    assert [r[:3] for r in rows] == [("desktop", 2, 0), ("desktop", 2, 20), ("desktop", 2, 40)]


def test_spread_conserves_density_and_clamps(spark):
    rows = report(spark, "cruxFcp", rum_rows=[
        rum(fcp=[(0, 200, 0.5), (200, 60_000, 0.5)]), rum(fcp=None), rum(fcp=[]), rum(fcp=[(300, None, 1.0), (400, 400, 1.0)]),
    ])
    assert len(rows) == 52 and rows[0][:2] == ("desktop", 0.0)
    assert sum(r[2] for r in rows) == pytest.approx(1.0)
    assert max(r[1] for r in rows) == 5.1 and rows[-1][4] == pytest.approx(1)


def test_layout_shift_steps_are_exact(spark):
    # Repeated float addition would give six steps here; exact steps give five.
    rows = report(spark, "cruxCls", rum_rows=[rum(cls=[(Decimal("0.05"), Decimal("0.1"), 1.0)], device="tablet")])
    assert [str(r[1]) for r in rows] == [f"0.0{i}0000000" for i in range(5, 10)]
    assert {r[0] for r in rows} == {"mobile"} and rows[0][2] == pytest.approx(0.2)


def test_raw_bins(spark):
    rows = report(spark, "cruxInp", rum_rows=[rum(inp=[(100, 500, 0.25), (500, 900, 0.75)])])
    assert [(r[1], r[2]) for r in rows] == [(100, 0.25), (500, 0.75)]


def test_lenses_on_real_user_rows(spark):
    crawl = [page("https://a.example/", technologies=["Drupal"]), page("https://a.example/", technologies=["Drupal"]),
             page("https://b.example/", technologies=["Drupal"], client="mobile")]
    users = [rum("https://a.example", inp=[(1, 2, 1.0)]), rum("https://b.example", inp=[(1, 2, 1.0)]),
             rum("https://b.example", "phone", inp=[(3, 4, 1.0)], rank=10_000)]
    drupal = report(spark, "cruxInp", "drupal", pages=crawl, rum_rows=users)
    assert [(r[0], r[1], r[2]) for r in drupal] == [("desktop", 1, 1.0), ("mobile", 3, 1.0)]
    top1k = report(spark, "cruxInp", "top1k", rum_rows=users)
    assert [(r[0], r[2]) for r in top1k] == [("desktop", 2.0)]


def test_one_scan_equals_single_runs(spark):
    from pyspark.sql import functions as F

    crawl = [page(f"https://s{i}.example/", rank=10 ** (3 + i % 4), technologies=["Drupal"] if i % 3 else None,
                  summary={"bytesCss": i * 5000, "reqCss": i % 4, "_connections": i}) for i in range(40)]
    users = [rum(f"https://s{i}.example", rank=10 ** (3 + i % 4), fcp=[(i * 100, i * 100 + 250, 1.0)], ttfb=[(i, i + 1, 1.0)])
             for i in range(40)]
    requests = [request(f"https://s{i % 40}.example/", rank=10 ** (3 + i % 40 % 4), payload={"_cpu.EvaluateScript": i * 7}) for i in range(90)]
    t = tables(spark, crawl, requests, users)
    names = ["bytesCss", "reqCss", "tcp", "evalJs", "cruxFcp", "cruxTtfb"]
    together = histograms.histograms(t, [m.HISTOGRAMS[n] for n in names], lens.select("ALL"), ["2023-05-01"])
    together = {tuple(r) for r in together.withColumns({c: F.round(c, 9) for c in ("volume", "pdf", "cdf")}).collect()}
    single = set()
    for name in names:
        for x in lens.select("ALL"):
            one = histograms.histograms(t, [m.HISTOGRAMS[name]], [x], ["2023-05-01"])
            single |= {tuple(r) for r in one.withColumns({c: F.round(c, 9) for c in ("volume", "pdf", "cdf")}).collect()}
    assert together == single and len(single) > 100


def test_top1m_crawl_lens_stops_at_10k(spark):
    pages = [page(summary={"reqCss": 1}, rank=r) for r in (1_000, 10_000, 100_000, 1_000_000, None)]
    assert [r[1] for r in report(spark, "reqCss", "top1m", pages=pages)] == [2]
    assert [r[1] for r in report(spark, "reqCss", "top100k", pages=pages)] == [3]
