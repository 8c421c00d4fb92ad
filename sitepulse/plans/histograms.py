"""Histogram reports. Any number of metrics, lenses and dates share one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sitepulse.functions import rum, scalar
from sitepulse.operators import histogram, joins
from sitepulse.plans import lens as lenses_, metrics as m
from sitepulse.plans.facts import page_facts, request_facts
from sitepulse.plans.lens import Lens
from sitepulse.plans.tables import CrawlTables, scan

KEYS = ("lens", "metric", "date", "client")
COLUMNS = (*KEYS, "bin", "volume", "pdf", "cdf")


def _on_dates(table: DataFrame, dates: Sequence[str] | None) -> DataFrame:
    if dates is None:
        return table
    return table.where(F.col("date").isin(*[F.to_date(F.lit(d)) for d in dates]))


def _condition(metric: m.CrawlHistogram, bin: Column) -> Column:
    """Rows a metric counts. Conditions on the bin hold per row, so no HAVING is left."""
    keep = F.lit(True)
    if metric.floor:
        keep = keep & (F.col("date") >= F.to_date(F.lit(metric.floor)))
    if metric.positive:
        keep = keep & F.coalesce(F.col(metric.fact) > 0, F.lit(False))
    if not metric.keep_null:
        keep = keep & bin.isNotNull()
    if metric.minimum is not None:
        keep = keep & F.coalesce(bin >= F.lit(metric.minimum), F.lit(False))
    return keep


def _bins(rows: DataFrame, metrics: Sequence[m.CrawlHistogram]) -> DataFrame:
    """One row per input row and metric that counts it: ``number`` of the metric and its ``bin``.

    The bins of a row are built side by side, NaN standing for "not counted", and exploded. No
    filter on a parsed value is left that could move below the parse and repeat it.
    """
    bins = []
    for metric in metrics:
        bin = metric.bin(F.col(metric.fact))
        bins.append(F.when(_condition(metric, bin), bin.cast("double")).otherwise(F.lit(float("nan"))))
    exploded = rows.select("*", F.posexplode(F.array(*bins)).alias("number", "bin"))
    return exploded.where(F.col("bin").isNull() | ~F.isnan("bin"))


def _named(rows: DataFrame, metrics: Sequence) -> DataFrame:
    """Replace the metric number by its name."""
    names = F.array(*[F.lit(metric.name) for metric in metrics])
    return rows.withColumn("metric", F.get(names, F.col("number"))).drop("number")


def crawl_histograms(
    tables: CrawlTables,
    metrics: Sequence[m.CrawlHistogram],
    lenses: Sequence[Lens],
    dates: Sequence[str] | None = None,
) -> DataFrame:
    """Histograms over page facts, in one scan.

    Pages are counted per combination of lenses; only those counts are then spread over lenses.
    """
    pages = _on_dates(scan(tables.pages, root_only=True), dates)
    floors = [metric.floor for metric in metrics]
    if all(floors):
        pages = scan(pages, since=min(floors))
    if len(lenses) == 1:
        pages = pages.where(lenses[0].on_pages())
    rows = page_facts(pages, [x.fact for x in metrics])
    in_lenses = lenses_.mask(lenses) if len(lenses) > 1 else F.lit(1)
    counts = (
        _bins(rows.withColumn("mask", in_lenses), metrics)
        .groupBy("mask", "number", "date", "client", "bin")
        .agg(F.count(F.lit(1)).alias("volume"))
    )
    return histogram.pdf_cdf(_per_lens(_named(counts, metrics), lenses), KEYS).select(*COLUMNS)


def _per_lens(sums: DataFrame, lenses: Sequence[Lens]) -> DataFrame:
    """Volumes per lens from volumes per combination of lenses."""
    if len(lenses) == 1:
        return sums.withColumn("lens", F.lit(lenses[0].name)).drop("mask")
    return lenses_.unmask(sums, lenses).groupBy(*KEYS, "bin").agg(F.sum("volume").alias("volume"))


def request_histograms(
    tables: CrawlTables,
    metrics: Sequence[m.CrawlHistogram],
    lenses: Sequence[Lens],
    dates: Sequence[str] | None = None,
) -> DataFrame:
    """Histograms over request facts of crawled pages. Bins are counted per page before the join."""
    pages = _on_dates(scan(tables.pages, root_only=True), dates)
    requests = request_facts(
        _on_dates(scan(tables.requests, root_only=True), dates), [x.fact for x in metrics]
    )
    joined = joins.sums_on_pages(
        _bins(requests, metrics), pages, {"volume": F.lit(1)}, ("number", "bin"), lenses_.subsets(lenses)
    )
    counts = _named(joined, metrics).groupBy(*KEYS, "bin").agg(F.sum("volume").alias("volume"))
    return histogram.pdf_cdf(counts, KEYS).select(*COLUMNS)


def _with_rum_mask(rows: DataFrame, pages: DataFrame | None, lenses: Sequence[Lens]) -> DataFrame:
    """Add ``mask``, one bit per lens a site is in.

    Rank lenses read the row itself. All technology lenses share one join to the crawled sites of
    the month, reduced to one row per site and month.
    """
    if len(lenses) == 1:
        return lenses[0].restrict_rum(rows, pages, on_month=True).withColumn("mask", F.lit(1))
    by_site = [lens for lens in lenses if lens.technology is not None]
    if by_site:
        flags = {f"_in_{lens.name}": lens.on_pages() for lens in by_site}
        in_any = F.lit(False)
        for flag in flags.values():
            in_any = in_any | flag
        sites = (
            pages.where(in_any)
            .groupBy(
                scalar.drop_last_char(F.col("page")).alias("_origin"),
                rum.form_factor_of(F.col("client")).alias("_form_factor"),
                F.date_format("date", "yyyyMM").cast("int").alias("_yyyymm"),
            )
            .agg(*[F.max(flag).alias(name) for name, flag in flags.items()])
        )
        rows = rows.join(
            sites,
            (F.col("origin") == F.col("_origin"))
            & (F.col("form_factor.name") == F.col("_form_factor"))
            & (F.col("yyyymm") == F.col("_yyyymm")),
            "left",
        )
    bits = F.lit(0)
    for i, lens in enumerate(lenses):
        if lens.technology is not None:
            member = F.col(f"_in_{lens.name}")
        elif lens.rum_rank is not None:
            member = F.col("experimental.popularity.rank") <= F.lit(lens.rum_rank)
        else:
            member = F.lit(True)
        bits = bits + F.when(member, F.lit(1 << i)).otherwise(F.lit(0))
    return rows.withColumn("mask", bits)


# Bin edges of all metrics in one exact type: whole billionths. Milliseconds and layout shifts both fit.
_UNIT = 10**9


def _billionths(edge: Column, dtype: T.DataType) -> Column:
    # Whole numbers need no decimals, which are objects: two a bin, for every bin of every row.
    if isinstance(dtype, T.IntegralType):
        return edge.cast("bigint") * F.lit(_UNIT).cast("bigint")
    return (edge.cast("decimal(28,9)") * F.lit(_UNIT)).cast("bigint")


def _from_billionths(edge: str) -> Column:
    """The double nearest to the edge."""
    whole = F.expr(f"{edge} div {_UNIT}").cast("double")
    return F.when(F.col(edge) % _UNIT == 0, whole).otherwise(F.col(edge).cast("double") / F.lit(float(_UNIT)))


def _rum_volumes(rows: DataFrame, metrics: Sequence[m.RumHistogram], lenses: Sequence[Lens]) -> DataFrame:
    """Volume per bin of every metric, from one pass over the rows.

    Densities are summed per given bin and combination of lenses, then per lens; only those sums are spread over
    finer steps.
    """

    def in_billionths(metric: m.RumHistogram) -> Column:
        bins = F.col(f"{metric.path}.histogram.bin")
        kinds = {field.name: field.dataType for field in rows.select(bins).schema[0].dataType.elementType}
        edge = lambda b, name: _billionths(b[name], kinds[name]).alias(name)
        return F.transform(bins, lambda b: F.struct(edge(b, "start"), edge(b, "end"), b["density"].cast("double").alias("density")))

    given = F.array(*[in_billionths(metric) for metric in metrics])
    by = ["mask", "number", "yyyymm", "client"]
    each = rows.select(
        "mask",
        "yyyymm",
        rum.client_of(F.col("form_factor.name")).alias("client"),
        F.posexplode(given).alias("number", "bins"),
    )
    summed = _named(histogram.bin_volumes(each, F.col("bins"), by), metrics)
    if len(lenses) == 1:
        summed = summed.withColumn("lens", F.lit(lenses[0].name))
    else:
        merged = ["lens", "metric", "yyyymm", "client", "start", "end"]
        summed = lenses_.unmask(summed, lenses).groupBy(*merged).agg(F.sum("density").alias("density"))
    summed = summed.withColumn("date", scalar.month_date(F.col("yyyymm")))

    def per_metric(value: str, unit: int | None = None) -> Column:
        of = [getattr(metric, value) for metric in metrics]
        scaled = of if unit is None else [None if x is None else round(float(x) * unit) for x in of]
        values = F.array(*[F.lit(x).cast("bigint") if unit else F.lit(x) for x in scaled])
        names = F.array(*[F.lit(metric.name) for metric in metrics])
        return F.get(values, (F.array_position(names, F.col("metric")) - 1).cast("int"))

    steps = rum.spread(
        F.col("start"), F.col("end"), F.col("density"), per_metric("width", _UNIT), per_metric("clamp", _UNIT), "bigint"
    )
    kept = F.array(F.struct(F.col("start").alias("start"), F.col("density").alias("density")))
    pieces = F.when(per_metric("width", _UNIT).isNotNull(), steps).otherwise(kept)
    return (
        summed.select(*KEYS, F.explode(pieces).alias("s"))
        .groupBy(*KEYS, F.col("s.start").alias("start"))
        .agg(F.sum("s.density").alias("volume"))
        .withColumn("bin", _from_billionths("start") / per_metric("scale"))
        .drop("start")
    )


def rum_histograms(
    tables: CrawlTables,
    metrics: Sequence[m.RumHistogram],
    lenses: Sequence[Lens],
    dates: Sequence[str] | None = None,
) -> DataFrame:
    """Histograms over the pre-binned table. Each metric's column is read once."""
    rows = tables.rum
    if dates is not None:
        rows = rows.where(F.col("yyyymm").isin(*[int(d[:4] + d[5:7]) for d in dates]))
    by_site = any(lens.technology is not None for lens in lenses)
    pages = _on_dates(tables.pages, dates) if by_site else None
    volumes = _rum_volumes(_with_rum_mask(rows, pages, lenses), metrics, lenses)
    return histogram.pdf_cdf(volumes, KEYS).select(*COLUMNS)


def histograms(
    tables: CrawlTables,
    metrics: Sequence[m.CrawlHistogram | m.RumHistogram],
    lenses: Sequence[Lens],
    dates: Sequence[str] | None = None,
) -> DataFrame | None:
    """All given histograms in long form: ``lens, metric, date, client, bin, volume, pdf, cdf``."""
    parts = []
    on_pages = [x for x in metrics if isinstance(x, m.CrawlHistogram) and x.source == "pages"]
    on_requests = [x for x in metrics if isinstance(x, m.CrawlHistogram) and x.source == "requests"]
    on_rum = [x for x in metrics if isinstance(x, m.RumHistogram)]
    if on_pages:
        parts.append(crawl_histograms(tables, on_pages, lenses, dates))
    if on_requests:
        parts.append(request_histograms(tables, on_requests, lenses, dates))
    if on_rum:
        parts.append(rum_histograms(tables, on_rum, lenses, dates))
    result = None
    for part in parts:
        part = part.withColumn("volume", F.col("volume").cast("double"))
        result = part if result is None else result.unionByName(part)
    return result


def shape(long: DataFrame, metric: m.CrawlHistogram | m.RumHistogram) -> DataFrame:
    """One metric's rows in report columns and types, without ordering."""
    rows = long.where(F.col("metric") == metric.name)
    if isinstance(metric, m.RumHistogram):
        bin = F.col("bin").cast("decimal(38,9)") if metric.exact_edges else F.col("bin")
        bin = bin.cast("bigint") if metric.width is None else bin
        return rows.select("lens", "date", "client", bin.alias("bin"), "volume", "pdf", "cdf")
    bin = F.col("bin").cast("bigint") if metric.whole_bins else F.col("bin")
    return rows.select(
        "lens", "date", "client", F.col("volume").cast("bigint").alias("volume"), bin.alias("bin"),
        "pdf", "cdf",
    )


def report(tables: CrawlTables, name: str, date: str, lens: str | None = None) -> DataFrame:
    """One histogram report as published: one metric, one date, one lens, in report order."""
    metric = m.HISTOGRAMS[name]
    chosen = [lenses_.get(lens or lenses_.BASE)]
    rows = shape(histograms(tables, [metric], chosen, [date]), metric).drop("lens", "date")
    return histogram.ordered(rows)
