"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the input (default sf0.1), ``BENCH_CPUS`` the cores (default 8),
``BENCH_RUNS`` the timed runs per query (default 3, after one warm-up; the median counts). The two
runs over every report go once.
Results go to a sink that computes every row and stores none.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from contract import analogs, registry
from sitepulse.plans import histograms, lens, metrics as m, series
from sitepulse.session import local_session

HEADLINES = (
    "histogram_bytes", "histogram_join_round", "rum_histogram_spread", "hist_bytesTotal", "hist_evalJs",
    "hist_cruxFcp", "hist_cruxCls", "ts_quantiles_1001", "ts_bytesTotal", "ts_a11yScores", "ts_badgeSet",
    "ts_h3", "ts_imgLazy", "ts_cruxPassesCWV", "lens_drupal_rum_hist", "lens_top10k_rum_series",
    "eda_hist50", "eda_cdf", "classify_requests", "rank_directory_join", "har_import", "body_truncate_utf8",
    "dedup_keys", "one_scan_histograms", "one_scan_series", "one_join_requests",
)


def every_histogram(spark, sf_dir):
    """37 histograms x 8 lenses x every date."""
    return histograms.histograms(analogs.tables(spark, sf_dir), list(m.HISTOGRAMS.values()), lens.select(lens.ALL))


def every_series(spark, sf_dir):
    """71 time series x 8 lenses."""
    return series.series(analogs.tables(spark, sf_dir), list(m.SERIES.values()), lens.select(lens.ALL))


def seconds(query, spark, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores, runs = int(os.environ.get("BENCH_CPUS", "8")), int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, shuffle_partitions=cores)
    queries = {name: registry.registered()[name][0] for name in HEADLINES}
    queries |= {"every_histogram": every_histogram, "every_series": every_series}
    timed = {}
    for name, query in queries.items():
        whole = name.startswith("every_")
        repeats = 1 if whole else runs
        if not whole:
            seconds(query, spark, sf_dir)
        timed[name] = round(statistics.median(seconds(query, spark, sf_dir) for _ in range(repeats)), 3)
        print(f"{name} {timed[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
