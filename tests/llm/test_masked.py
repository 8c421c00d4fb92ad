"""Training and scores of the window network."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitepulse.llm import masked, queries

SMALL = masked.Settings(digit=8, hashed=16, batch=256)


@pytest.fixture(scope="module")
def trained(documents):
    return masked.train(documents.filter("doc_id % 5 <> 0"), settings=SMALL)


def test_vocabulary_counts_all_texts(documents, trained):
    vocab, _ = trained
    counts = Counter()
    for r in documents.filter("doc_id % 5 <> 0").collect():
        counts.update(r.text.encode().lower().split())
    want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: 64 - 16 - 1]
    assert list(zip(vocab.words, vocab.counts)) == want
    assert vocab.others == sum(counts.values()) - sum(n for _, n in want)


def test_beats_word_frequencies_on_held_out_texts(documents, trained):
    vocab, network = trained
    held = documents.filter("doc_id % 5 = 0")
    got = masked.score(held, vocab, network).agg(F.sum("pll"), F.sum("n_words")).first()
    coder, logs = masked.Coder(vocab), np.log(vocab.frequencies())
    frequencies = sum(logs[coder(r.text.encode())].sum() for r in held.collect())
    assert got[0] > frequencies
    assert got[1] == sum(len(r.text.split()) for r in held.collect())


def test_scores_by_hand(spark, trained):
    vocab, network = trained
    texts = ["the of and the", "one", "", None, " \n", "The OF and the"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in masked.score(rows, vocab, network).collect()}
    table, w = vocab.table(), network.w

    def code(word):
        return table.get(word, 64 - 16 + zlib.crc32(word) % 16)

    for i, text in enumerate(texts):
        codes = [code(x) for x in (text or "").encode().lower().split()]
        padded = [0, 0, *codes, 0, 0]
        total = 0.0
        for at, c in enumerate(codes):
            around = padded[at : at + 2] + padded[at + 3 : at + 5]
            h = np.tanh(np.concatenate([w["embed"][x] for x in around]) @ w["hidden"] + w["bias"])
            a, b = h @ w["high"] + w["high_bias"], h @ w["low"] + w["low_bias"][c // 8]
            total += a[c // 8] - math.log(np.exp(a).sum()) + b[c % 8] - math.log(np.exp(b).sum())
        assert math.isclose(got[i].pll, total, rel_tol=1e-4, abs_tol=1e-9)
        assert got[i].n_words == len(codes)
    assert got[2].mean_pll is None and got[0].pll == got[5].pll


def test_step_follows_the_gradient():
    settings = masked.Settings(digit=4, hashed=4, width=3, hidden=5, rate=1e-2)
    rng = np.random.default_rng(0)
    around, target = rng.integers(0, 16, (64, 4)), rng.integers(0, 16, 64)
    start = masked.Network(settings)
    moved = masked.Network(settings)
    moved.step(around, target)
    gradient = (start.flat().astype(float) - moved.flat()) / settings.rate

    def loss(flat):
        return -start.with_flat(flat).log_probabilities(around, target).mean()

    flat = start.flat().astype(np.float64)
    for i in rng.choice(len(flat), 40, replace=False):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-2
        down[i] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - gradient[i]) < 2e-3


def test_query_over_all_documents(spark, sf_dir, documents):
    rows = queries.op6_masked(spark, sf_dir).collect()
    assert len(rows) == documents.count()
    assert all(math.isfinite(r.pll) and r.pll < 0 for r in rows if r.n_words)


def test_odd_rows(odd_documents):
    vocab, network = masked.train(odd_documents, settings=SMALL)
    rows = masked.score(odd_documents, vocab, network).collect()
    assert len(rows) == odd_documents.count()
    empty = odd_documents.limit(0)
    vocab, network = masked.train(empty, settings=SMALL)
    assert vocab.words == () and masked.score(empty, vocab, network).count() == 0
    assert masked.score(odd_documents, vocab, network).count() == len(rows)
