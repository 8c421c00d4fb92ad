"""Held-out accuracy of the text, and what the other evidence adds."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitepulse.llm import language, queries

KIND = "page_id bigint, url string, html string"


@pytest.fixture(scope="module")
def model(documents):
    return language.learn(documents.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))


def test_held_out_texts(spark, documents, model):
    rows = [r for r in documents.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and len(r.text) > 40]
    pages = spark.createDataFrame([(r.doc_id, None, r.text.replace("<", " ")) for r in rows], KIND)
    got = {r.page_id: r for r in language.identify(pages, model).collect()}
    right = sum(got[r.doc_id].lang == r.lang for r in rows)
    assert len(rows) > 40 and right >= 0.97 * len(rows)


def test_counts_are_those_of_all_texts(spark, documents, model):
    kept = [r for r in documents.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    counts = np.full(model.logs.shape, 0.5)
    for r in kept:
        np.add.at(counts[model.languages.index(r.lang)], language.trigrams(r.text, 1 << 15), 1)
    assert np.allclose(model.logs, np.log(counts / counts.sum(axis=1, keepdims=True)), atol=1e-5)


def test_query_over_all_pages(spark, sf_dir):
    rows = queries.op9_language(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert all(0 < r.confidence <= 1 for r in rows)
    assert sum(r.lang == r.declared for r in rows) > 0.9 * len(rows)


def page(text, lang=None):
    return f"<!DOCTYPE html><html{f' lang={lang}' if lang else ''}><head><script>la de que el</script></head><p>{text}</p></html>"


def test_hosts_declarations_and_markup(spark, documents, model):
    texts = {x: [r.text[:400] for r in documents.filter(F.col("lang") == x).limit(8).collect()] for x in ("fr", "de")}
    rows = [(i, "http://www.a.example/x", page(t, "fr")) for i, t in enumerate(texts["fr"])]
    rows += [(20 + i, "https://user@b.example:80/", page(t, "de")) for i, t in enumerate(texts["de"])]
    rows += [(50, "http://www.a.example/empty", page("")), (51, "http://new.a.example/", page("")), (52, "http://b.example", page(""))]
    rows += [(53, "http://b.example/wrong", page(texts["fr"][0], "de")), (54, None, page("", "de"))]
    got = {r.page_id: r for r in language.identify(spark.createDataFrame(rows, KIND), model).collect()}
    assert [got[i].lang for i in (0, 20, 50, 51, 52, 53, 54)] == ["fr", "de", "fr", "fr", "de", "fr", "de"]
    assert got[20].host == "b.example" and got[50].text_lang is None and got[53].declared == "de"
    assert got[50].confidence > got[51].confidence


def test_fusion_by_hand(spark, model):
    """The posterior of every page, recomputed from the evidence table."""
    rng = random.Random(1)
    words = ["the", "und", "der", "que", "le", "de", "that", "ing", "lichen"]
    rows = [
        (i, rng.choice([None, "http://x.a.de/", "http://y.a.de/", "http://b.fr/", "bad url"]),
         page(" ".join(rng.choices(words, k=rng.randrange(0, 6))), rng.choice([None, "de", "fr", "xx"])))
        for i in range(60)
    ]
    pages = spark.createDataFrame(rows, KIND)
    s = language.Settings()
    seen = language.evidence(pages, model, "page_id", "url", "html", s).collect()
    n = len(model.languages)
    post = {r._key: np.exp(np.array(r._logs) - max(r._logs)) for r in seen}
    post = {k: p / p.sum() for k, p in post.items()}
    telling = [r for r in seen if r._grams]
    prior = (sum(post[r._key] for r in telling) + 1) / (len(telling) + n)

    def logs(field, value):
        values = {getattr(r, field) for r in telling} - {None}
        if value not in values:
            return np.zeros(n)
        count = sum(post[r._key] for r in telling if getattr(r, field) == value)
        whole = sum(post[r._key] for r in telling if getattr(r, field) is not None)
        return np.log((count + s.smoothing) / (whole + s.smoothing * (len(values) + 1)))

    def level(field, r, above):
        # Only hosts with a page that tells something have counts.
        known = any(x._host == r._host for x in telling) and r._host is not None
        others = [x for x in telling if known and getattr(x, field) == getattr(r, field) and x._key != r._key]
        return (sum((post[x._key] for x in others), np.zeros(n)) + s.weight * above) / (len(others) + s.weight)

    got = {r.page_id: r for r in language.identify(pages, model).collect()}
    for r in seen:
        at = level("_host", r, level("_domain", r, prior))
        fused = np.array(r._logs) + np.log(at) + logs("_declared", r._declared) + logs("_suffix", r._suffix)
        fused = np.exp(fused - fused.max())
        fused /= fused.sum()
        assert math.isclose(got[r._key].confidence, fused.max(), rel_tol=1e-9)
        assert got[r._key].lang == model.languages[int(fused.argmax())]


def test_odd_rows(spark, odd_documents, model):
    odd = odd_documents.selectExpr("doc_id page_id", "source url", "text html", "_id lang", "n_chars _post")
    assert language.identify(odd, model).count() == odd.count()
    assert language.identify(odd.limit(0), model).count() == 0
    none = language.learn(odd_documents.limit(0).withColumn("lang", F.lit("x")))
    assert none.languages == ()
    assert [r.lang for r in language.identify(odd, none).collect()] == [None] * odd.count()


def test_declaration_after_a_long_start(spark, model):
    """The <html> tag counts wherever it stands."""
    rows = [
        (1, None, f"<!-- {'licence ' * 20_000} -->" + page("", "de")),
        (2, None, " " * 5_000 + "<HTML class=x\n LANG='FR-ca'>"),
        (3, None, "x" * 5_000 + page("")),
    ]
    got = {r.page_id: r.declared for r in language.identify(spark.createDataFrame(rows, KIND), model).collect()}
    assert got == {1: "de", 2: "fr", 3: None}


def test_every_language_is_learned(spark):
    """Also those beyond the 64 most frequent ones."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = {f"l{i:02}": " ".join([letters[i // 26] + letters[i % 26] + letters[(7 * i) % 26] + "q"] * 30) for i in range(70)}
    rows = [(x, t) for x, t in texts.items()] + [(x, t) for x, t in list(texts.items())[:64]]
    learned = language.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert learned.languages == tuple(sorted(texts))
    pages = spark.createDataFrame([(i, None, page(texts[f"l{i:02}"])) for i in range(64, 70)], KIND)
    assert {r.page_id: r.lang for r in language.identify(pages, learned).collect()} == {i: f"l{i:02}" for i in range(64, 70)}


def test_rare_values_speak_too(spark, model):
    """Results are the same however many values are broadcast."""
    rows = [(i, f"http://h{i}.x{i % 7}/", page("und der die das" if i % 2 else "", ["de", "fr", "xx", None][i % 4])) for i in range(40)]
    pages = spark.createDataFrame([*rows, (40, None, None)], KIND)
    want = {r.page_id: r for r in language.identify(pages, model).collect()}
    got = {r.page_id: r for r in language.identify(pages, model, settings=language.Settings(values=1)).collect()}
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert got[k].lang == r.lang and math.isclose(got[k].confidence, r.confidence, rel_tol=1e-9)


def test_markup_is_removed_in_one_pass():
    """As a pattern that goes back would, and megabytes of unclosed tags in seconds."""
    import html
    import random
    import re
    import time

    pattern = re.compile(r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
    rng = random.Random(3)
    parts = ["<script>", "</script>", "<STYLE x>", "</style >", "<!--", "-->", "<", ">", "<b>", "text", " &amp; ", "<!-->", "</noscript>", "<noscript"]
    for _ in range(3000):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert language.visible(page) == html.unescape(pattern.sub(" ", page)), page
    start = time.perf_counter()
    for opened in ("<script ", "<!-- ", "<", "<script>", "</script "):
        language.visible(opened * (5_000_000 // len(opened)))
    assert time.perf_counter() - start < 20
