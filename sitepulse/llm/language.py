"""Language of web pages by fusing evidence with Bayes' rule.

Four sources speak: the visible text (character trigrams), the language that the markup declares, the suffix of the
address, and the host. How far a declaration or a suffix can be trusted is read off the pages themselves: the counts
of each value under the languages that the texts suggest. A host's prior is smoothed towards its domain's and that
towards the whole corpus, and leaves the page itself out. All counts are grouped aggregates.
"""

from __future__ import annotations

import html as markup
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.text import over_texts, utf8, values
from sitepulse.session import stage

_OPENED = re.compile(r"(?i)<(?:(script|style|noscript)\b|!--)")
_CLOSED = {kind: re.compile(rf"(?i)</{kind}\s*>") for kind in ("script", "style", "noscript")} | {"comment": re.compile("-->")}
# Every <html> tag, up to its end or that of the page, and the language it names. Neither goes back over what it read.
_TAGS, _LANG = r"(?i)<html\b[^>]*+", r"(?is)^<html\b.*?\blang\s*+=\s*+[\"']?+([a-z]{2,3})\b"
_HOST = r"(?i)^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:\s]+)"


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 15  # of hashed trigrams
    grams: float = 60.0  # a text weighs no more than so many trigrams, for they are not independent
    smoothing: float = 0.5
    values: int = 1_000  # declared languages and suffixes that are broadcast, the most frequent ones; others are shuffled
    weight: float = 4.0  # of the level above, in pages, when a host or domain is smoothed


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    logs: np.ndarray  # [language, bucket]


def trigrams(text: str, buckets: int) -> np.ndarray:
    """Buckets of the letter trigrams of a text; what is no letter is one blank."""
    letters = re.sub(r"[\W\d_]+", " ", f" {text.lower()} ")
    points = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(points) < 3:
        return np.zeros(0, np.int64)
    code = (points[:-2] * np.uint64(0x9E3779B1) + points[1:-1]) * np.uint64(0x85EBCA77) + points[2:]
    code = (code ^ (code >> np.uint64(17))) * np.uint64(0xC2B2AE3D)
    return ((code >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def visible(page: str) -> str:
    """Text of a page without tags, comments, and scripts and styles that are closed; in one pass over the page."""
    out, at, unclosed = [], 0, set()
    while (start := page.find("<", at)) >= 0:
        opened = _OPENED.match(page, start)
        kind = (opened[1] or "comment").lower() if opened else None
        end = None
        if kind and kind not in unclosed:
            end = _CLOSED[kind].search(page, opened.end())
            if end is None:
                unclosed.add(kind)  # nor further on
        stop = end.end() if end else page.find(">", start) + 1
        if not stop:
            break
        out += [page[at:start], " "]
        at = stop
    return markup.unescape("".join([*out, page[at:]]))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> TextModel:
    """Trigram counts of every text by language, summed by Spark; rows without text or language do not count.

    The result has a row of ``buckets`` numbers for every language that occurs. Without any row it has no language.
    """
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    languages = tuple(sorted(r.l for r in rows.select(F.col(lang).alias("l")).distinct().collect()))
    place = {x: i for i, x in enumerate(languages)}
    buckets = settings.buckets

    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for code, body in zip(batch.column(0).to_pylist(), values(batch.column(1))):
                if code not in totals:
                    totals[code] = np.zeros(buckets, np.int64)
                np.add.at(totals[code], trigrams(body.decode("utf-8", "replace"), buckets), 1)
        for code, total in totals.items():
            bucket = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(bucket), place[code], np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[bucket])],
                names=["l", "bucket", "n"],
            )

    counts = np.full((len(languages), buckets), settings.smoothing)
    if languages:
        given = rows.select(F.col(lang).alias("_lang"), utf8(text).alias("_text"))
        summed = given.mapInArrow(run, "l int, bucket int, n bigint").groupBy("l", "bucket").agg(F.sum("n").alias("n"))
        found = summed.toPandas()
        counts[found["l"], found["bucket"]] += found["n"]
    return TextModel(languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))


def evidence(pages: DataFrame, model: TextModel, key: str, url: str, html: str, settings: Settings) -> DataFrame:
    """(key, host, domain, suffix, declared, n_grams, text): log-likelihoods of the text by language.

    A null or unusable URL has no host, a null or empty page no trigrams and likelihoods of 0.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _HOST, 1))
    host = F.rtrim(host, F.lit("."))
    host = F.when(host != "", host)
    # Of the first <html> tag that names one, wherever it stands in the page.
    tags = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(_TAGS), F.lit(0))
    named = F.filter(F.transform(tags, lambda t: F.lower(F.regexp_extract(t, _LANG, 1))), lambda x: x != "")
    labels = F.split(host, r"\.")
    rows = pages.select(
        F.col(key).cast("bigint").alias("_key"),
        host.alias("_host"),
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("_domain"),
        F.element_at(labels, -1).alias("_suffix"),
        F.get(named, F.lit(0)).alias("_declared"),
        utf8(html).alias("_text"),
    )

    def of_batch(given, texts):
        grams, logs = [], []
        for text in texts:
            found = trigrams(visible(text.decode("utf-8", "replace")), settings.buckets)
            grams.append(len(found))
            weight = min(1.0, settings.grams / len(found)) if len(found) else 0.0
            logs.append(model.logs[:, found].sum(axis=1, dtype=np.float64) * weight)
        return given | {"n": grams, "t": logs}

    schema = "_key bigint, _host string, _domain string, _suffix string, _declared string, _grams bigint, _logs array<double>"
    return over_texts(rows, schema, of_batch)


def _posterior(logs: Column) -> Column:
    """Probabilities from log-likelihoods."""
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def _sums(rows: DataFrame, by: list[str], n: int, name: str) -> DataFrame:
    """Summed posteriors by language, as one array, and the number of pages."""
    sums = [F.sum(F.get("_post", F.lit(i))).alias(f"_s{i}") for i in range(n)]
    summed = rows.groupBy(*by).agg(F.count("*").cast("double").alias(f"{name}_n"), *sums)
    return summed.withColumn(name, F.array(*(f"_s{i}" for i in range(n)))).drop(*(f"_s{i}" for i in range(n)))


def _likelihoods(rows: DataFrame, value: str, n: int, name: str, settings: Settings) -> DataFrame:
    """log P(value | language) for every value, and its number of pages ``_c_n``."""
    counted = stage(_sums(rows.filter(F.col(value).isNotNull()), [value], n, "_c"), "values")
    # One row of a number per language.
    whole = counted.agg(F.count("*"), *(F.coalesce(F.sum(F.get("_c", F.lit(i))), F.lit(0.0)) for i in range(n))).first()
    logs = [
        F.log((F.get("_c", F.lit(i)) + settings.smoothing) / F.lit(whole[1 + i] + settings.smoothing * (whole[0] + 1)))
        for i in range(n)
    ]
    return counted.select(value, F.array(*logs).alias(name), "_c_n")


def _looked_up(pages: DataFrame, table: DataFrame, value: str, name: str, settings: Settings) -> DataFrame:
    """``pages`` with ``name`` of their value, null where the table has none.

    The most frequent values are broadcast, so no key of the shuffle that finds the others has many pages; pages that
    need no shuffle are spread over salts that match nothing.
    """
    top = stage(table.orderBy(F.desc("_c_n"), value).limit(settings.values + 1).drop("_c_n"), "frequent-values")
    frequent = pages.join(F.broadcast(top), value, "left")
    if top.count() <= settings.values:
        return frequent
    rare = table.join(F.broadcast(top.select(value)), value, "left_anti")
    rare = rare.select(F.col(value).alias("_rare"), F.lit(0).alias("_rare_salt"), F.col(name).alias("_rare_logs"))
    open_ = F.col(value).isNotNull() & F.col(name).isNull()
    salted = frequent.withColumns(
        {
            "_rare": F.when(open_, F.col(value)).otherwise(F.lit("")),
            "_rare_salt": F.when(open_, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("_key", "_host"), F.lit(65_536)).cast("int")),
        }
    )
    joined = salted.join(rare, ["_rare", "_rare_salt"], "left")
    return joined.withColumn(name, F.coalesce(name, "_rare_logs")).drop("_rare", "_rare_salt", "_rare_logs")


def identify(
    pages: DataFrame,
    model: TextModel,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    settings: Settings = Settings(),
) -> DataFrame:
    """Per page: the key, ``lang``, ``confidence``, ``text_lang``, ``declared`` and ``host``.

    ``lang`` is the language of the highest posterior, the first in code point order among equals; ``text_lang`` that of
    the text alone, null without text. A page without any evidence gets the language most frequent in the corpus; if the
    model has no language, all are null. Repeated rows are pages of their own.
    """
    n = len(model.languages)
    if not n:
        nothing = F.lit(None).cast("string")
        host = evidence(pages, model, key, url, html, settings)
        return host.select(
            F.col("_key").alias(key), nothing.alias("lang"), F.lit(None).cast("double").alias("confidence"),
            nothing.alias("text_lang"), F.col("_declared").alias("declared"), F.col("_host").alias("host"),
        )
    seen = stage(evidence(pages, model, key, url, html, settings), "page-evidence")
    seen = seen.withColumn("_post", _posterior(F.col("_logs")))
    # Pages without text suggest no language, so they do not count towards the others.
    telling = seen.filter("_grams > 0")
    zeros = F.array(*[F.lit(0.0)] * n)
    row = _sums(telling, [], n, "_all").select("_all_n", *(F.coalesce(F.get("_all", F.lit(i)), F.lit(0.0)) for i in range(n))).first()
    prior = F.array(*(F.lit((row[1 + i] + 1.0) / (row[0] + n)) for i in range(n)))
    # Tables of a row per value, and one of a row per host, which adaptive execution may split or broadcast.
    declared = _likelihoods(telling, "_declared", n, "_by_declared", settings)
    suffixes = _likelihoods(telling, "_suffix", n, "_by_suffix", settings)
    hosts = stage(_sums(telling, ["_host", "_domain"], n, "_on_host"), "hosts")
    domains = hosts.groupBy("_domain").agg(
        F.sum("_on_host_n").alias("_on_domain_n"),
        F.array(*(F.sum(F.get("_on_host", F.lit(i))) for i in range(n))).alias("_on_domain"),
    )
    places = stage(
        hosts.filter(F.col("_host").isNotNull()).join(domains, "_domain").drop("_domain"), "host-priors"
    )
    joined = _looked_up(seen, declared, "_declared", "_by_declared", settings)
    joined = _looked_up(joined, suffixes, "_suffix", "_by_suffix", settings).join(places, "_host", "left")
    own = F.when(F.col("_grams") > 0, F.lit(1.0)).otherwise(F.lit(0.0))

    def less_own(counts: str, above: Column, size: str) -> Column:
        """Smoothed shares of a level without this page."""
        rest = F.zip_with(F.coalesce(counts, zeros), "_post", lambda c, p: F.greatest(c - p * own, F.lit(0.0)))
        pages_left = F.greatest(F.coalesce(size, F.lit(0.0)) - own, F.lit(0.0))
        return F.zip_with(rest, above, lambda c, a: (c + settings.weight * a) / (pages_left + settings.weight))

    joined = joined.withColumn("_of_domain", less_own("_on_domain", prior, "_on_domain_n"))
    joined = joined.withColumn("_of_host", less_own("_on_host", F.col("_of_domain"), "_on_host_n"))
    fused = F.zip_with("_logs", F.transform("_of_host", lambda x: F.log(x)), lambda a, b: a + b)
    for name in ("_by_declared", "_by_suffix"):
        fused = F.zip_with(fused, F.coalesce(name, zeros), lambda a, b: a + b)
    result = joined.withColumn("_fused", _posterior(fused))
    names = F.array(*(F.lit(x) for x in model.languages))

    def best(values: str) -> Column:
        return F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))

    return result.select(
        F.col("_key").alias(key),
        best("_fused").alias("lang"),
        F.array_max("_fused").alias("confidence"),
        F.when(F.col("_grams") > 0, best("_post")).alias("text_lang"),
        F.col("_declared").alias("declared"),
        F.col("_host").alias("host"),
    )
