import datetime as dt

import pytest
from crawl import DAY, page, request, summary, tables

from sitepulse.plans import series


def report(spark, name, lens=None, after=None, until=None, **rows):
    return [r.asDict() for r in series.report(tables(spark, **rows), name, lens, after, until).collect()]


def test_dates_and_quantile_positions(spark):
    pages = [page(summary={"bytesCss": 1024 * i}) for i in range(0, 1002)]
    (row,) = report(spark, "bytesCss", pages=pages)
    # Zero is filtered; position 501 of 1001, not the median of 1,000 steps.
    assert row == {"date": "2023_05_01", "timestamp": 1682899200000, "client": "desktop",
                   "p10": 101, "p25": 251, "p50": 501, "p75": 751, "p90": 901}


def test_first_paint_is_divided_by_1024_and_empty_groups_drop(spark):
    key = "_chromeUserTiming.firstContentfulPaint"
    pages = [page(payload={key: 2048}), page(client="mobile")]
    assert [(r["client"], r["p50"]) for r in report(spark, "fcp", pages=pages)] == [("desktop", 2.0)]
    # Without that condition the group stays, with NULLs.
    assert [(r["client"], r["p50"]) for r in report(spark, "gzipSavings", pages=pages)] == [("desktop", None), ("mobile", None)]


def test_interactive_falls_back_in_its_own_order(spark):
    doc = {"audits": {"interactive": {"rawValue": 9000}, "consistently-interactive": {"rawValue": 5000}}}
    assert report(spark, "ttci", pages=[page(lighthouse=doc)])[0]["p50"] == 9


@pytest.mark.parametrize("score, passes", [("true", True), ("1", True), ('"1"', True), ("1.0", True), ("0", False),
                                           ("false", False), ('"1.0"', False), ("null", False), ("0.9", False)])
def test_score_types(spark, score, passes):
    doc = f'{{"audits": {{"button-name": {{"score": {score}}}}}}}'
    rows = report(spark, "a11yButtonName", pages=[page(lighthouse=doc), page(lighthouse="{ }"), page()])
    assert rows[0]["percent"] == (100.0 if passes else 0.0)


def test_only_audited_pages_count(spark):
    doc = {"audits": {"font-display": {"score": 1}, "font-size": {"score": 1}}}
    pages = [page(lighthouse=doc), page(lighthouse={"audits": {}}), page(lighthouse="{}")]
    assert report(spark, "fontDisplay", pages=pages)[0]["percent"] == 100
    assert report(spark, "legible", pages=pages)[0]["percent"] == 100
    assert report(spark, "fontDisplay", pages=pages[1:]) == []


def test_accessibility_score_formats(spark):
    old = {"reportCategories": [{"name": "Other", "score": 1}, {"name": "Accessibility", "score": 81.5}]}
    assert report(spark, "a11yScores", pages=[page(lighthouse=old)])[0]["p50"] == 81.5
    new = {"categories": {"accessibility": {"score": 0.62}}, **old}
    assert report(spark, "a11yScores", pages=[page(lighthouse=new)])[0]["p50"] == 62.0
    missing = {"reportCategories": [{"name": "Other", "score": 1}]}
    assert report(spark, "a11yScores", pages=[page(lighthouse=missing)])[0]["p50"] is None


def test_feature_rows_count_like_a_left_unnest(spark):
    both = [("2726", "BadgeSet"), (None, "BadgeSet"), ("2726", "Other"), ("1", "x")]
    pages = [page(features=both), page(features=[]), page(features=None), page(features=[("1", "x")])]
    (row,) = report(spark, "badgeSet", pages=pages)
    # Three matching rows, two with an id, and three pages without a match.
    assert (row["num_urls"], row["percent"]) == (2, round(2 / 6 * 100, 5))
    worker = [("990", None), (None, "ServiceWorkerControlledPage"), (None, "x")]
    (row,) = report(spark, "swControlledPages", pages=[page(features=worker), page()])
    assert (row["num_urls"], row["percent"]) == (2, round(2 / 3 * 100, 5))


def test_two_features_share_an_id(spark):
    pages = [page(features=[("3018", "DurableStoragePersist")])]
    assert report(spark, "webSocketStream", pages=pages)[0]["num_urls"] == 1
    assert report(spark, "storagePersist", pages=pages)[0]["num_urls"] == 1


def test_lazy_images_count_distinct_pages(spark):
    pages = [page(other={"img-loading-attr": ["eager", "LAZY"]}), page(other={"img-loading-attr": []}),
             page("https://b.example/", other={}), page("https://c.example/")]
    assert report(spark, "imgLazy", pages=pages)[0]["percent"] == 33.33


def test_http3_headers(spark):
    def row(headers, version=None):
        return request(headers=headers, summary={"respHttpVersion": version} if version else None)

    requests = [
        row([("alt-svc", 'h3=":443"')]), row([("alt-svc", "clear"), ("alt-svc", 'h3-29=":1"')]),
        row([("alt-svc", 'quic=":443", x = h3=":443"')]), row([("server", "h3=")]), row(None, "h3"),
        row([("alt-svc", "a"), ("alt-svc", "b")], "HTTP/3"),
    ]
    # Rows 1+2+1+1+1+2; hits 1+1+0+0+1+2.
    assert report(spark, "h3", pages=[page()], requests=requests)[0]["percent"] == 62.5


def test_https_share_uses_only_crawled_pages(spark):
    requests = [request(url="https://x"), request(url="http://x"), request("https://gone.example/", url="https://x")]
    assert report(spark, "pctHttps", pages=[page()], requests=requests)[0]["percent"] == 50


def test_rum_shares(spark):
    good, zero, poor = {"fast_lcp": 3, "avg_lcp": 1, "slow_lcp": 0}, dict.fromkeys(("fast_lcp", "avg_lcp", "slow_lcp"), 0), \
        {"fast_lcp": 1, "avg_lcp": 2, "slow_lcp": 1}
    rows = [summary("https://a", **good), summary("https://a", **poor), summary("https://b", **poor), summary("https://c", **zero),
            summary("https://d", "tablet", **good), summary("https://e", "phone", **zero), summary("https://f", month=201908, **good)]
    found = {(r["date"], r["client"]): r["percent"] for r in report(spark, "cruxFastLcp", summaries=rows)}
    assert found == {("2023_05_01", "desktop"): 50.0, ("2023_05_01", "mobile"): None}
    assert report(spark, "cruxSlowLcp", summaries=rows)[0]["percent"] == 100.0


def test_vitals_switch_and_missing_responsiveness(spark):
    base = {"p75_lcp": 1, "p75_cls": 1, "fast_lcp": 1, "avg_lcp": 0, "slow_lcp": 0, "small_cls": 1, "medium_cls": 0, "large_cls": 0}
    bad_inp = {"p75_inp": 1, "fast_inp": 0, "avg_inp": 0, "slow_inp": 1}
    rows = [summary("https://a", month=m, **base, **bad_inp) for m in (202401, 202402, 201909)]
    rows += [summary("https://n", month=202402, **{**base, "p75_lcp": None})]
    assert [(r["date"], r["percent"]) for r in report(spark, "cruxPassesCWV", summaries=rows)] == [("2024_02_01", 0.0), ("2024_01_01", 100.0)]


def test_rank_lens_on_summary_is_a_single_bucket(spark):
    pages = [page("https://a/", rank=1000), page("https://b/", rank=10_000), page("https://c/", rank=10_000, root=False),
             page("https://d/", rank=10_000, client="mobile")]
    shares = {"fast_ol": 1, "avg_ol": 0, "slow_ol": 0}
    rows = [summary(f"https://{x}", **shares) for x in "abcd"] + [summary("https://d", "phone", **shares)]
    found = report(spark, "cruxFastOl", "top10k", pages=pages, summaries=rows)
    assert [r["client"] for r in found] == ["desktop", "mobile"]


def test_bounds(spark):
    days = [DAY, dt.date(2023, 6, 1), dt.date(2023, 7, 1)]
    pages = [page(date=d) for d in days]
    assert [r["date"] for r in report(spark, "numUrls", after="2023-05-01", until="2023-06-01", pages=pages)] == ["2023_06_01"]
