"""The lexicon on held-out rows, folding, exceptions and odd rows."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from sitepulse.llm import queries, toxicity


def test_held_out_accuracy(spark):
    got = queries.op8_toxicity(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.join(labels.dropDuplicates(["doc_id"]), "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert len(rows) > 100 and right >= 0.95 * len(rows)
    assert not any(r.predicted and not r.toxic for r in rows)
    assert got.count() == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()


def test_folds(spark):
    rows = spark.range(30).select("id", toxicity.fold_of("id").alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 3 for r in rows)


@pytest.mark.parametrize(
    ("text", "folded"),
    [
        ("You are an 1D10T!", " you are an idiot "),
        ("Ѕtuріd, $tup1d", " stupid stupid "),
        ("call 555-2186 now", " call now "),
        ("mor​on", " moron "),
        ("", "  "),
        (" \n", "  "),
    ],
)
def test_fold(text, folded):
    assert toxicity.fold(text) == folded


def test_exceptions_and_length():
    lexicon = toxicity.Lexicon({" trash ": 5.0, " idio": 6.0}, ("trash can",), (-3.0, 3.0))
    m = lexicon.matcher()
    assert m.hits(toxicity.fold("the trash can, idiots")) == {m_index("the trash can, idiots", "idiots"): 6.0}
    short, long = "trash " + "word " * 10, "trash " + "word " * 5000
    assert m.score(short) > 0.7 > m.score(long)
    assert m.score(None) == m.score("")


def m_index(text, word):
    return toxicity.fold(text).index(f" {word}")


def _corpus(spark, exception):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(900):
        w = [f"w{rng.randrange(300)}x".replace("w", "qu") + "abcdefghij"[rng.randrange(10)] for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            w[rng.randrange(40)] = rng.choice(["zgroble", "zgrobler", "zgroblest"])
        elif exception and i % 7 == 0:
            at = rng.randrange(39)
            w[at : at + 2] = ["kind", "zgroble"]
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_learns_words_and_exceptions(spark):
    docs, labels = _corpus(spark, exception=True)
    training = toxicity.Training(least_weight=0.5, least_share=0.4)
    lexicon = toxicity.learn(docs, labels, training=training)
    assert any("zgrobl" in e for e in lexicon.weights)
    assert "kind zgroble" in lexicon.exceptions
    m = lexicon.matcher()
    assert m.score("a b c kind zgroble d e f") < 0.5 < m.score("a b c zgr0ble d e f")


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = _corpus(spark, exception=False)
    flipped = labels.withColumn("toxic", F.when(toxicity.fold_of("doc_id") == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn(docs, labels) == toxicity.learn(docs, flipped)


def test_odd_rows(spark, odd_documents):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    nulls = spark.createDataFrame([(None, 1), (1, None), (1, 0), (1, 1), (2, 0)], "doc_id bigint, toxic int")
    for labels in (none, nulls):
        lexicon = toxicity.learn(odd_documents, labels)
        scored = odd_documents.withColumn("s", toxicity.score(lexicon)).collect()
        assert len(scored) == odd_documents.count() and all(0 <= r.s <= 1 for r in scored)
    kept = toxicity.accepted(odd_documents, lexicon)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count()
    assert toxicity.accepted(odd_documents.limit(0), lexicon).count() == 0
