"""The registry is complete, and registered queries match their check SQL."""

import os

import pytest
from compare import check, duck

import __spark_entry__ as entry
from contract import registry
from sitepulse.plans import lens, metrics as m

# One or more queries of every family; RUN_ALL=1 runs all of them.
SAMPLE = """hist_bootupJs hist_bytesTotal hist_evalJs hist_tcp hist_ttci hist_cruxCls hist_cruxFcp hist_cruxInp
ts_bytesCss ts_tcp ts_a11yScores ts_legible ts_badgeSet ts_webSocketStream ts_h3 ts_imgLazy ts_numUrls ts_cruxSlowLcp
ts_cruxPassesCWV lens_drupal_hist lens_drupal_rum_hist lens_top1m_rum_series lens_top1k_requests lens_wordpress_series
histogram_null_bins unnest_left eda_hist50 eda_quartiles eda_cdf_points exact_quantiles har_requests har_bodies
har_technologies har_import incremental_ingest body_truncate_utf8 csv_load dedup_keys classify_requests
rank_directory_join directory_read delete_date run_reports one_scan_lenses one_join_requests typed_facts""".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_catalogue_is_complete():
    assert len(m.HISTOGRAMS) == 37
    assert len(m.SERIES) == 71
    assert len(lens.LENSES) == 7
    assert sum(m.is_rum(x) for x in m.HISTOGRAMS.values()) == 8
    assert sum(m.is_rum(x) for x in m.SERIES.values()) == 14


def test_every_query_has_a_check():
    found = registry.registered()
    assert all(sql for _, sql in found.values())
    assert set(found) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(registry.registered()) if os.environ.get("RUN_ALL") else SAMPLE)
def test_query_matches_sql(name, spark, con, sf_dir):
    problem, _, _, _ = check(spark, con, sf_dir, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem is None, problem
