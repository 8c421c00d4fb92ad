"""The registered queries of this subpackage: name -> (query, check SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm import arc, language, masked, mixing, pieces, search, simhash, sketches, spelling, substrings, toxicity, vectors, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and survivor of every embedding, at a cosine of 0.93 within its label."""
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through ARC and WARC records and back."""
    return arc.archived(_table(spark, sf_dir, "pages"))


def op3_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products for every hundredth vector, against all."""
    rows = search.sparse(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return search.top_k(rows.filter("id % 100 = 0"), rows, k=10)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix of all sources with weights 5, 2, 1, ... takes."""
    return mixing.report(_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 4-word shingles, linked at 4 or fewer differing bits, of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp0")).alias("fingerprint"), "component_id")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page, with a text model learned from all documents."""
    model = language.learn(_table(spark, sf_dir, "documents"))
    return language.identify(_table(spark, sf_dir, "pages"), model)


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What windows of 35 words that occur twice leave of every document."""
    return substrings.report(_table(spark, sf_dir, "documents"))


def op6_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document under a network trained on all of them."""
    documents = _table(spark, sf_dir, "documents")
    vocabulary, network = masked.train(documents)
    return masked.score(documents, vocabulary, network)


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as ids of the public 32,000-piece vocabulary, and whether they decode to it."""
    return pieces.encoded(_table(spark, sf_dir, "documents"), pieces.load())


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a lexicon learned from the rows that are not held out."""
    documents = _table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(documents, _table(spark, sf_dir, "labels"))
    held_out = F.coalesce(toxicity.fold_of("doc_id") == 1, F.lit(False))
    scored = documents.select("doc_id", held_out.alias("held_out"), toxicity.score(lexicon).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all documents with its more frequent spelling."""
    return spelling.report(_table(spark, sf_dir, "documents"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketch of every document and of its edited text, and how like they and the next document's are."""
    return sketches.report(_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 32 strongest whitened components of all of them."""
    return whitening.report(_table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {
        "op1_vectors": (op1_vectors, vectors.SQL),
        "op2_archive": (op2_archive, None),
        "op3_search": (op3_search, search.SQL),
        "op4_mixing": (op4_mixing, mixing.SQL),
        "op5_simhash": (op5_simhash, None),
        "op6_masked": (op6_masked, None),
        "op7_pieces": (op7_pieces, None),
        "op8_toxicity": (op8_toxicity, None),
        "op9_language": (op9_language, None),
        "op10_substrings": (op10_substrings, None),
        "op11_spelling": (op11_spelling, None),
        "op12_fingerprints": (op12_fingerprints, None),
        "op13_whitening": (op13_whitening, None),
    }
