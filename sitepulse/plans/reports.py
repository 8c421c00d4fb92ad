"""Keeping reports up to date: readiness, incremental runs, forced runs, deletion, export.

All reports live in two long tables. Histograms are immutable per (date, lens, metric) and are
overwritten partition by partition. Time series are partitioned by date: a run replaces only the dates whose rows it
changes, and then notes how far each (lens, metric) has come. A job that dies before that leaves the mark where it was, and
the next run replaces the same dates again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sitepulse.functions import scalar
from sitepulse.plans import histograms, lens as lenses_, metrics as m, series
from sitepulse.plans.tables import CrawlTables
from sitepulse.session import drop, stage

HISTOGRAM_SCHEMA = (
    "client string, bin double, volume double, pdf double, cdf double, date string, lens string, metric string"
)
SERIES_SCHEMA = (
    "date string, timestamp bigint, client string, "
    + ", ".join(f"{name} {dtype}" for name, dtype in series.MEASURES.items())
    + ", lens string, metric string"
)
_REACHED = "lens string, metric string, date string, change bigint"
CLIENTS = ("desktop", "mobile")
# Fixed value: the most rows of one report that the published reader fetches; a limit only where asked for.
MAX_REPORT_ROWS = 1_000_000


class NotReady(RuntimeError):
    """The crawl of a date is not complete."""


class ReportTooLarge(RuntimeError):
    """A report holds more rows than a reader may fetch."""


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class ReportStore:
    """The two report tables below one folder. One writer at a time."""

    spark: SparkSession
    root: str

    # -- histograms

    def histograms(self) -> DataFrame:
        return _read_or_empty(self.spark, f"{self.root}/histograms", HISTOGRAM_SCHEMA)

    def write_histograms(self, long: DataFrame) -> None:
        """Replace exactly the (date, lens, metric) partitions that ``long`` holds."""
        (
            long.withColumn("date", scalar.report_date(F.col("date")))
            .repartition("date", "lens", "metric")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date", "lens", "metric")
            .parquet(f"{self.root}/histograms")
        )

    def existing_histograms(self, date: str) -> set[tuple[str, str]]:
        """(lens, metric) pairs that already have a report of the date."""
        found = self.histograms().where(F.col("date") == date).select("lens", "metric").distinct()
        return {(row.lens, row.metric) for row in found.toLocalIterator()}

    # -- time series

    def series(self) -> DataFrame:
        return _read_or_empty(self.spark, f"{self.root}/series", SERIES_SCHEMA)

    def replace_series(self, fresh: DataFrame, replaced: Sequence[tuple[str, str]] = (), gone: Column | None = None) -> None:
        """Put ``fresh`` rows in place of those of the same (date, lens, metric).

        All other rows of the ``replaced`` pairs go, and rows that are ``gone``. Only dates with a changed row are
        written; a date without any row left loses its folder.
        """
        columns = [f.name for f in self.spark.createDataFrame([], SERIES_SCHEMA).schema]
        fresh = stage(fresh.select(*columns), "fresh-series")
        old = self.series().select(*columns)
        out = F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))
        for lens_names, names in _batches(replaced):
            out = out | (F.col("lens").isin(*lens_names) & F.col("metric").isin(*names))
        # A short list: one date per crawl.
        touched = [r.date for r in old.where(out).select("date").union(fresh.select("date")).distinct().collect()]
        if not touched:
            return
        kept = old.where(F.col("date").isin(*touched) & ~out).join(fresh, ["date", "lens", "metric"], "left_anti")
        content = stage(fresh.unionByName(kept), "changed-series")
        (
            content.repartition("date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date")
            .parquet(f"{self.root}/series")
        )
        left = {r.date for r in content.select("date").distinct().collect()}
        for date in sorted(set(touched) - left):
            drop(self.spark, f"{self.root}/series/date={date}")

    def record_reached(self, reached: dict[tuple[str, str], str | None]) -> None:
        """Note up to which date series are complete, also those that have no row; None: from the start again."""
        if reached:
            log = _read_or_empty(self.spark, f"{self.root}/reached", _REACHED)
            change = (log.agg(F.max("change")).first()[0] or 0) + 1
            rows = [(lens, metric, date, change) for (lens, metric), date in reached.items()]
            self.spark.createDataFrame(rows, _REACHED).coalesce(1).write.mode("append").parquet(f"{self.root}/reached")

    def newest(self, pairs: Sequence[tuple[str, str]]) -> dict[tuple[str, str], str | None]:
        """The newest row's date of each pair, None for one without rows."""
        found = self.series().groupBy("lens", "metric").agg(F.max("date").alias("date")).collect()
        dates = {(r.lens, r.metric): r.date for r in found}
        return {pair: dates.get(pair) for pair in pairs}

    def last_dates(self) -> dict[tuple[str, str], str]:
        """The date each (lens, metric) series has reached; one row a pair."""
        noted = _read_or_empty(self.spark, f"{self.root}/reached", _REACHED)
        noted = noted.groupBy("lens", "metric").agg(F.max_by("date", "change").alias("date")).where("date IS NOT NULL")
        return {(row.lens, row.metric): row.date for row in noted.toLocalIterator()}


# ---------------------------------------------------------------- readiness and dates


def readiness(tables: CrawlTables, *dates: str) -> DataFrame:
    """Rows in each slice a crawl needs, per date: one pass over the partitions of the dates, or of all."""
    parts = []
    for name, table in (("pages", tables.pages), ("requests", tables.requests)):
        asked = table.where(F.col("date").isin(*[F.to_date(F.lit(d)) for d in dates])) if dates else table
        found = (
            asked
            .where(F.col("client").isin(*CLIENTS) & F.col("is_root_page").isNotNull())
            .groupBy("date", "client", "is_root_page")
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        parts.append(found.select("date", F.lit(name).alias("source"), "client", "is_root_page", "rows"))
    return parts[0].unionByName(parts[1])


def ready_dates(tables: CrawlTables, *dates: str) -> DataFrame:
    """Dates, of those asked for or of all, whose eight slices all have rows."""
    slices = 2 * len(CLIENTS) * 2
    counted = readiness(tables, *dates).groupBy("date").agg(F.count(F.lit(1)).alias("slices"))
    return counted.where(F.col("slices") == slices).select("date")


def missing_slices(tables: CrawlTables, date: str) -> list[tuple[str, str, bool]]:
    """Slices of (table, client, root page or not) that have no row; empty when ready."""
    found = {(r.source, r.client, r.is_root_page) for r in readiness(tables, date).collect()}
    needed = [(s, c, root) for s in ("pages", "requests") for c in CLIENTS for root in (True, False)]
    return [slice_ for slice_ in needed if slice_ not in found]


def list_dates(table: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Distinct crawl dates as text, newest first, between two optional ``YYYY_MM_DD`` bounds."""
    dates = table.select(scalar.report_date(F.col("date")).alias("date")).distinct()
    if first:
        dates = dates.where(F.col("date") >= first)
    if last:
        dates = dates.where(F.col("date") <= last)
    return dates.orderBy(F.col("date").desc())


def list_shard_dates(suffixes: DataFrame, kind: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Dates of table shards named ``YY_MM_DD_<client>_<kind>``, newest first."""
    dates = (
        suffixes.where(F.col("suffix").like(f"%\\_{kind}%"))
        .select(scalar.shard_date(F.col("suffix")).alias("date"))
        .distinct()
    )
    if first:
        dates = dates.where(F.col("date") >= first)
    if last:
        dates = dates.where(F.col("date") <= last)
    return dates.orderBy(F.col("date").desc())


def add_date(dates: Iterable[str], date: str) -> list[str]:
    """A list of dates with one more, each once, newest first."""
    return sorted({*dates, date}, reverse=True)


# ---------------------------------------------------------------- running


def _iso(date: str) -> str:
    return date.replace("_", "-")


def _batches(pairs: Iterable[tuple[str, str]]) -> list[tuple[list[str], list[str]]]:
    """Group (lens, metric) pairs into rectangles: lenses that need the same metrics."""
    by_lens: dict[str, list[str]] = {}
    for lens, metric in pairs:
        by_lens.setdefault(lens, []).append(metric)
    by_metrics: dict[tuple[str, ...], list[str]] = {}
    for lens, names in by_lens.items():
        by_metrics.setdefault(tuple(names), []).append(lens)
    return [(lenses, list(names)) for names, lenses in by_metrics.items()]


def run_histograms(
    tables: CrawlTables, store: ReportStore, date: str, lens: str | None = None, pattern: str = "*", force: bool = False
) -> list[tuple[str, str]]:
    """Write the histogram reports of one date; returns the (lens, metric) pairs computed.

    Refuses when the crawl is incomplete. Reports that exist are skipped unless forced. Lenses
    that lack the same reports share one scan.
    """
    missing = missing_slices(tables, _iso(date))
    if missing:
        raise NotReady(f"crawl {date} lacks {missing}")
    done = set() if force else store.existing_histograms(date)
    chosen = [metric.name for metric in m.matching(m.HISTOGRAMS, pattern)]
    pairs = [(x.name, name) for x in lenses_.select(lens) for name in chosen if (x.name, name) not in done]
    for lens_names, names in _batches(pairs):
        long = histograms.histograms(
            tables, [m.HISTOGRAMS[n] for n in names], [lenses_.get(x) for x in lens_names], [_iso(date)]
        )
        store.write_histograms(long)
    return pairs


def plan_series(
    last: dict[tuple[str, str], str], date: str | None, lens: str | None, pattern: str, force: bool
) -> dict[str | None, list[tuple[str, str]]]:
    """Series to compute, by the date after which each starts (None: from the start).

    Crawl series continue after their newest date; real-user series are always recomputed. A
    series that already reaches ``date`` is left alone.
    """
    planned: dict[str | None, list[tuple[str, str]]] = {}
    for x in lenses_.select(lens):
        for metric in m.matching(m.SERIES, pattern):
            newest = last.get((x.name, metric.name))
            start = None
            if newest is not None and not force:
                if date is not None and newest >= date:
                    continue
                start = None if m.is_rum(metric) else newest
            planned.setdefault(start, []).append((x.name, metric.name))
    return planned


def run_series(
    tables: CrawlTables,
    store: ReportStore,
    date: str | None = None,
    lens: str | None = None,
    pattern: str = "*",
    force: bool = False,
) -> list[tuple[str, str]]:
    """Bring the time series up to ``date`` (or to the newest crawl); returns the pairs computed."""
    planned = plan_series(store.last_dates(), date, lens, pattern, force)
    if not planned:
        return []
    until = _iso(date) if date else None
    fresh, pairs, replaced = None, [], []
    for start, wanted in planned.items():
        for lens_names, names in _batches(wanted):
            long = series.series(
                tables, [m.SERIES[n] for n in names], [lenses_.get(x) for x in lens_names],
                after=_iso(start) if start else None, until=until,
            )
            fresh = long if fresh is None else fresh.unionByName(long)
        pairs += wanted
        if start is None:
            replaced += wanted
    store.replace_series(fresh, replaced)
    crawled = [pair for pair in pairs if not m.is_rum(m.SERIES[pair[1]])]
    reached: dict[tuple[str, str], str | None] = {}
    if crawled and tables.pages is not None:
        until = date or tables.pages.agg(scalar.report_date(F.max("date"))).first()[0]
        reached = dict.fromkeys(crawled, until)
    store.record_reached(reached | store.newest([pair for pair in pairs if pair not in reached]))
    return pairs


def run_reports(
    tables: CrawlTables,
    store: ReportStore,
    histogram_date: str | None = None,
    timeseries: bool = False,
    lens: str | None = None,
    pattern: str = "*",
    force: bool = False,
) -> dict[str, list[tuple[str, str]]]:
    """Generate histograms of a date, time series, or both."""
    if histogram_date is None and not timeseries:
        raise ValueError("ask for histograms of a date, for time series, or for both")
    done: dict[str, list[tuple[str, str]]] = {}
    if histogram_date is not None:
        done["histograms"] = run_histograms(tables, store, histogram_date, lens, pattern, force)
    if timeseries:
        done["timeseries"] = run_series(tables, store, histogram_date, lens, pattern, force)
    return done


def backfill(
    tables: CrawlTables,
    store: ReportStore,
    dates: Sequence[str],
    lens: str | None = None,
    pattern: str = "*",
    force: bool = False,
) -> dict[str, list[tuple[str, str]]]:
    """Histograms of many dates, for instance of a new metric. Dates lacking the same reports
    share one scan of all of them."""
    wanted: dict[str, list[tuple[str, str]]] = {}
    chosen = [metric.name for metric in m.matching(m.HISTOGRAMS, pattern)]
    ready = {row.date.isoformat() for row in ready_dates(tables, *map(_iso, dates)).toLocalIterator()} if dates else set()
    for date in dates:
        if _iso(date) not in ready:
            raise NotReady(f"crawl {date} lacks {missing_slices(tables, _iso(date))}")
        done = set() if force else store.existing_histograms(date)
        wanted[date] = [(x.name, n) for x in lenses_.select(lens) for n in chosen if (x.name, n) not in done]
    same: dict[tuple[tuple[str, str], ...], list[str]] = {}
    for date, pairs in wanted.items():
        same.setdefault(tuple(pairs), []).append(date)
    for pairs, shared in same.items():
        for lens_names, names in _batches(pairs):
            long = histograms.histograms(
                tables, [m.HISTOGRAMS[n] for n in names], [lenses_.get(x) for x in lens_names], [_iso(d) for d in shared]
            )
            store.write_histograms(long)
    return wanted


def delete_date(
    store: ReportStore, date: str, lens: str | None = None, pattern: str = "*", dry_run: bool = False
) -> DataFrame:
    """Remove one date from the time series; returns what is left of them.

    Deleting the last date leaves an empty series.
    """
    names = [metric.name for metric in m.matching(m.SERIES, pattern)]
    chosen = [x.name for x in lenses_.select(lens)]
    gone = (F.col("date") == date) & F.col("lens").isin(*chosen) & F.col("metric").isin(*names)
    if dry_run:
        return store.series().where(~gone)
    store.replace_series(store.spark.createDataFrame([], SERIES_SCHEMA), gone=gone)
    # What was noted no longer holds; a series with rows continues after its newest one.
    store.record_reached(store.newest([(lens, metric) for lens in chosen for metric in names]))
    return store.series()


# ---------------------------------------------------------------- export and import


def _check_size(table: DataFrame, keys: Sequence[str], max_rows: int | None) -> None:
    if max_rows is None:
        return
    large = table.groupBy(*keys).count().where(F.col("count") > max_rows).first()
    if large is not None:
        raise ReportTooLarge(str(large))


def export_histograms(store: ReportStore, path: str, date: str, max_rows: int | None = None) -> None:
    """One JSON-lines report per lens and metric of a date."""
    rows = store.histograms().where(F.col("date") == date)
    _check_size(rows, ["lens", "metric"], max_rows)
    (
        rows.repartition("lens", "metric")
        # Partition columns first, in their order: the writer sorts by them, and would lose the order of the rows.
        .sortWithinPartitions("lens", "date", "metric", F.col("bin").asc_nulls_first(), "client")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("lens", "date", "metric")
        .json(path)
    )


def export_series(store: ReportStore, path: str, max_rows: int | None = None) -> None:
    """One JSON-lines report per lens and metric, newest date first; unused measures are left out."""
    rows = store.series()
    _check_size(rows, ["lens", "metric"], max_rows)
    (
        rows.repartition("lens", "metric")
        .sortWithinPartitions("lens", "metric", F.col("date").desc(), "client", F.col("num_urls").desc())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("lens", "metric")
        .json(path)
    )


def import_series(store: ReportStore, path: str, lens: str, metric: str, lines: bool = False) -> None:
    """Bring a published series, a JSON array or JSON ``lines``, into the store in place of what it has."""
    columns = [f for f in store.spark.createDataFrame([], SERIES_SCHEMA).schema if f.name not in ("lens", "metric")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
    given = read_json_report(store.spark, path, schema, lines).withColumns({"lens": F.lit(lens), "metric": F.lit(metric)})
    store.replace_series(given, [(lens, metric)])
    store.record_reached(store.newest([(lens, metric)]))


def read_json_report(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """A report published as one JSON array, or as JSON ``lines``."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)
