"""Jobs for ``spark-submit``: reports, deletions, date lists and imports.

    python -m sitepulse reports --tables T --store S --histograms 2024_01_01 --timeseries --lens ALL
    python -m sitepulse backfill --tables T --store S --dates 2024_01_01 2024_02_01 --reports newMetric
    python -m sitepulse classify --requests R --rules ad=ads.txt tracker=trackers.txt --target C
    python -m sitepulse directory --ranked RANKS.csv --directory DUMP.xml --target D
    python -m sitepulse delete-date --store S --date 2024_01_01 --lens top1k --reports "crux*"
    python -m sitepulse dates --tables T --min 2023_01_01
    python -m sitepulse import-series --store S --file REPORT.json --lens base --metric bytesCss
    python -m sitepulse import-har --source DIR --target T --max-size 2097152
    python -m sitepulse ingest-har --source DIR --target T --checkpoint C
    python -m sitepulse import-csv --archive mobile_Dec_15_2018 --pages P --requests R --target T
    python -m sitepulse extract-facts --tables T --target T2
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from sitepulse.operators import classify, directory
from sitepulse.plans import facts, reports
from sitepulse.plans.tables import CrawlTables
from sitepulse.session import SESSION_CONF, exists
from sitepulse.sources import csvdump, har, listings
from sitepulse.streaming import ingest


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="sitepulse")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, **required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for option, text in required.items():
            sub.add_argument(f"--{option}", required=True, help=text)
        return sub

    run = job("reports", tables="folder of the crawl tables", store="folder of the report tables")
    run.add_argument("--histograms", metavar="YYYY_MM_DD")
    run.add_argument("--timeseries", action="store_true")
    run.add_argument("--lens", help="one lens, or ALL")
    run.add_argument("--reports", default="*", help="glob of metric names")
    run.add_argument("--force", action="store_true")
    run.add_argument("--export", help="folder for JSON reports")
    fill = job("backfill", tables="folder of the crawl tables", store="folder of the report tables")
    fill.add_argument("--dates", nargs="+", required=True, metavar="YYYY_MM_DD")
    fill.add_argument("--lens")
    fill.add_argument("--reports", default="*")
    fill.add_argument("--force", action="store_true")
    kinds = job("classify", requests="folder of requests (page, url)", target="folder of the result")
    kinds.add_argument("--rules", nargs="+", required=True, metavar="LIST=FILE", help="in order of precedence")
    job("directory", ranked="CSV of rank and domain", directory="directory dump", target="folder of the result")
    drop = job("delete-date", store="folder of the report tables", date="YYYY_MM_DD")
    drop.add_argument("--lens")
    drop.add_argument("--reports", default="*")
    drop.add_argument("--dry-run", action="store_true")
    dates = job("dates", tables="folder of the crawl tables")
    dates.add_argument("--min")
    dates.add_argument("--max")
    har_job = job("import-har", source="folder of release folders, or a glob", target="folder of the tables")
    har_job.add_argument("--whole-files", action="store_true", help="one document per file")
    har_job.add_argument("--overwrite", action="store_true", help="replace releases that are there already")
    har_job.add_argument("--marker", help="file that has to exist before the import starts")
    ingest_job = job("ingest-har", source="folder of release folders", target="folder of the tables", checkpoint="shared folder")
    ingest_job.add_argument("--archive", help="folder that files done are moved to")
    for sub in (har_job, ingest_job):
        sub.add_argument("--max-size", type=int, help="rows over it go to the table of oversize rows; no limit by default")
        sub.add_argument("--in-bytes", action="store_true", help="sizes in UTF-8 bytes instead of characters")
        sub.add_argument("--url-fallback", action="store_true", help="a request without a full URL takes its short one")
    csv_job = job("import-csv", archive="name", pages="CSV", requests="CSV", target="folder of the tables")
    csv_job.add_argument("--unique", action="store_true", help="one row per identity, the lowest id")
    series_job = job("import-series", store="folder of the report tables", file="published report", lens="lens", metric="metric")
    series_job.add_argument("--lines", action="store_true", help="one JSON object a line instead of one array")
    job("extract-facts", tables="folder of the raw crawl tables", target="folder of the typed tables")
    return parser


def _limits(args: argparse.Namespace) -> har.HarOptions:
    return har.HarOptions(args.max_size, args.in_bytes, args.url_fallback)


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(arguments)
    if spark is None:
        builder = SparkSession.builder.appName(f"sitepulse {args.job}")
        for key, value in SESSION_CONF.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    if args.job == "reports":
        store = reports.ReportStore(spark, args.store)
        tables = CrawlTables.read(spark, args.tables)
        done = reports.run_reports(tables, store, args.histograms, args.timeseries, args.lens, args.reports, args.force)
        for kind, pairs in done.items():
            print(f"{kind}: {len(pairs)} reports")
        if args.export and args.histograms:
            reports.export_histograms(store, f"{args.export}/histograms", args.histograms)
        if args.export and args.timeseries:
            reports.export_series(store, f"{args.export}/timeseries")
    elif args.job == "backfill":
        store = reports.ReportStore(spark, args.store)
        done = reports.backfill(CrawlTables.read(spark, args.tables), store, args.dates, args.lens, args.reports, args.force)
        print(f"{sum(map(len, done.values()))} reports")
    elif args.job == "classify":
        lists = dict(rule.split("=", 1) for rule in args.rules)
        rules = classify.parse_rules(listings.read_rule_lists(spark, lists))
        classify.classify(spark.read.parquet(args.requests).select("page", "url"), rules).write.parquet(args.target)
    elif args.job == "directory":
        ranked = listings.read_ranked_domains(spark, args.ranked)
        entries = listings.read_directory(spark, args.directory)
        directory.ranked_directory(ranked, entries).write.parquet(args.target)
    elif args.job == "delete-date":
        store = reports.ReportStore(spark, args.store)
        left = reports.delete_date(store, args.date, args.lens, args.reports, args.dry_run)
        print(f"{left.count()} rows left")
    elif args.job == "dates":
        for row in reports.list_dates(CrawlTables.read(spark, args.tables).pages, args.min, args.max).toLocalIterator():
            print(row.date)
    elif args.job == "import-har":
        if args.marker and not exists(spark, args.marker):
            raise SystemExit(f"{args.marker} is missing: the crawl is not complete")
        docs = har.read_files(spark, args.source) if args.whole_files else har.read_lines(spark, args.source)
        docs = har.with_release(docs)
        if not args.overwrite:
            for date, client, files in har.imported(docs, args.target):
                print(f"skipped {date} {client}: there already, {files} files left out")
            docs = har.not_imported(docs, args.target)
        print(har.write_tables(docs, args.target, _limits(args), "overwrite" if args.overwrite else "append"))
    elif args.job == "ingest-har":
        print(ingest.ingest_hars(spark, args.source, args.target, args.checkpoint, _limits(args), archive=args.archive))
    elif args.job == "import-csv":
        print(csvdump.load_archive(spark, args.archive, args.pages, args.requests, args.target, args.unique))
    elif args.job == "import-series":
        store = reports.ReportStore(spark, args.store)
        reports.import_series(store, args.file, args.lens, args.metric, args.lines)
    elif args.job == "extract-facts":
        tables = CrawlTables.read(spark, args.tables)
        facts.write_page_facts(tables.pages, f"{args.target}/pages")
        facts.write_request_facts(tables.requests, f"{args.target}/requests")


if __name__ == "__main__":
    main()
