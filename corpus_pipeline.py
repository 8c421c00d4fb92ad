"""From raw documents to token ids: five stages, each over all that the one before kept.

1. toxicity: documents scored 0.7 or more by a lexicon learned from the labels go.
2. near duplicates: fingerprints over four-word shingles that differ in 4 bits at most are linked; one document of each
   group stays, the one with the smallest doc_id.
3. repeated passages: words in windows of 35 that occur anywhere else go, everywhere; documents all stay.
4. mixing: documents are left out or repeated so that sources meet their target weights, in training order. The order ends
   with this stage: its rows carry no position, and Spark packs its files anew when they are read.
5. token ids of the public 32,000-piece vocabulary, one row per document and repetition, in no order.

Nulls in any column, empty texts, repeated rows and empty tables pass through as the operators define it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm import mixing, pieces, simhash, substrings, toxicity
from sitepulse.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.accepted(docs, lexicon)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.cleaned(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.training_order(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = pieces.encode("text", pieces.load())
    return docs.select("doc_id", "lang", "source", ids.alias("ids")).withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("mixing", mix_sources),
    ("pieces", to_pieces),
]

#: A learned lexicon and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
