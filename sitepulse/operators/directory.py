"""Ranked domains joined to directory entries of their home pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sitepulse.functions import weburl
from sitepulse.session import stage

# Topics one row holds, about; a domain listed more often takes several rows, told apart by ``part``.
TOPICS_PER_ROW = 10_000
# Domains with more entries than one row may hold are broadcast up to this number.
_BROADCAST_ROWS = 100_000


def is_home_page(url: Column) -> Column:
    """Root path, no subdomain but ``www``, no query and no fragment."""
    return (
        (weburl.path(url) == "/")
        & weburl.subdomain(url).isin("", "www")
        & ~url.contains("?")
        & ~url.contains("#")
    )


def _ranked_once(ranked: DataFrame) -> DataFrame:
    """One row per domain; of several ranks the last, which is the highest, counts."""
    return ranked.groupBy("alexa_domain").agg(F.max(F.col("alexa_rank").cast("bigint")).alias("alexa_rank"))


def _home_pages(entries: DataFrame) -> DataFrame:
    return entries.where(is_home_page(F.col("url"))).withColumn("_domain", weburl.registered_domain(F.col("url")))


def ranked_directory(ranked: DataFrame, entries: DataFrame, topics_per_row: int = TOPICS_PER_ROW) -> DataFrame:
    """Every ranked domain and ``part`` with the topics of its home page and the first entry's texts.

    (domain, part) is the key at any size. Topics come in entry order; a domain with more entries than
    one row may hold is split over parts by the hash of their position, so no task collects an
    unbounded list and no topic is lost. A domain without entries has part 0 and no topics.
    """
    home = _home_pages(entries)
    # Few domains have more entries than a row may hold: no more than entries / topics_per_row.
    counted = home.groupBy("_domain").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > topics_per_row)
    heavy = stage(counted.select("_domain", F.ceil(F.col("_n") / F.lit(topics_per_row)).alias("_parts")), "heavy-domains")
    known = heavy.limit(_BROADCAST_ROWS + 1).count()
    topic = F.sort_array(F.collect_list(F.struct("position", "topic"))).alias("_topics")
    own = F.min_by(F.struct("url", "title", "description"), "position").alias("_first")
    if not known:
        found = home.groupBy("_domain").agg(topic, own).withColumn("part", F.lit(0))
    else:
        near = F.broadcast(heavy) if known <= _BROADCAST_ROWS else heavy
        light = home.join(near, "_domain", "left_anti").groupBy("_domain").agg(topic, own).withColumn("part", F.lit(0))
        dealt = home.join(near, "_domain").withColumn("part", F.pmod(F.xxhash64("position"), F.col("_parts")).cast("int"))
        parts = dealt.groupBy("_domain", "part").agg(topic, own, F.min("position").alias("_position"))
        first = parts.groupBy("_domain").agg(F.min_by("_first", "_position").alias("_first"))
        found = light.unionByName(parts.drop("_first", "_position").join(first, "_domain").select(*light.columns))
    return _ranked_once(ranked).join(found, F.col("alexa_domain") == F.col("_domain"), "left").select(
        "alexa_domain",
        "alexa_rank",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce(F.transform("_topics", lambda t: t["topic"]), F.array().cast("array<string>")).alias("dmoz_topic"),
        F.col("_first.url").alias("dmoz_url"),
        F.col("_first.title").alias("dmoz_title"),
        F.col("_first.description").alias("dmoz_description"),
    )


def domain_topics(ranked: DataFrame, entries: DataFrame) -> DataFrame:
    """The same join in long form: one row per ranked domain and directory entry."""
    home = _home_pages(entries)
    return _ranked_once(ranked).join(home, F.col("alexa_domain") == F.col("_domain")).select(
        "alexa_domain", "alexa_rank", "position", "topic", "url", "title", "description"
    )
