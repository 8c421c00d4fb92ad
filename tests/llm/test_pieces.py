"""Encoding against the sentencepiece library and brute force; exact round trips."""

import random

import numpy as np
import pytest

from sitepulse.llm import pieces, queries

ODD = [
    "", " ", "  a  b   c ", "▁x ▁▁y", "\n\n a\n  b\t\tc\r\n", "日本語テキスト ですよ", "émoji \U0001f600\U0001f600 \x00 z",
    "a" * 3000, "ab" * 900 + " " + "cd " * 30, "    " * 40, "x y", "naïve café",
]


@pytest.fixture(scope="module")
def model():
    return pieces.load()


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def split(codec, texts):
    ids, begins = codec.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(begins, begins[1:])]


def test_same_ids_as_the_library(model, library):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab \n é日\U0001f600.0▁th") for _ in range(rng.randrange(60))) for _ in range(2000)]
    codec = pieces.Codec(model)
    assert split(codec, texts) == [library.encode(t) for t in texts]
    assert [codec.decode(i) for i in split(codec, texts)] == [t.replace("▁", " ") for t in texts]
    # Also when most chunks are remembered, and when long chunks take the heap.
    assert split(codec, texts) == [library.encode(t) for t in texts]


def test_heap_and_rounds_agree(model, library, monkeypatch):
    texts = ODD + ["thereafterwards" * 7, "unbelievable antidisestablishmentarianism"]
    monkeypatch.setattr(pieces, "LONG_CHUNK", 1)
    assert split(pieces.Codec(model), texts) == [library.encode(t) for t in texts]


def test_query_round_trips(spark, sf_dir, documents, library):
    got = {r.doc_id: r for r in queries.op7_pieces(spark, sf_dir).collect()}
    for row in documents.collect():
        assert got[row.doc_id].round_trip
        assert list(got[row.doc_id].ids) == library.encode(row.text)
        assert got[row.doc_id].n_tokens == len(got[row.doc_id].ids)


def test_odd_rows(odd_documents, model, library):
    rows = pieces.encoded(odd_documents, model).collect()
    want = sorted((r.doc_id or -1, library.encode(r.text or "")) for r in odd_documents.collect())
    assert sorted((r.doc_id or -1, list(r.ids)) for r in rows) == want
    assert all(r.round_trip for r in rows)
    assert pieces.encoded(odd_documents.limit(0), model).count() == 0


def test_unigram_finds_the_best_sum():
    rng = random.Random(4)
    vocabulary = ["<unk>", "▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "ca", "cab", "▁ab"]
    scores = [0.0] + [-rng.uniform(1, 6) for _ in vocabulary[1:]]
    model = pieces.Model(tuple(vocabulary), tuple(scores), (False, *[True] * 11), (), 0, True, True)
    codec = pieces.Codec(model)
    number = {p: i for i, p in enumerate(vocabulary)}
    floor = min(scores[1:]) - 10.0

    def best(text):
        top = [0.0] + [-np.inf] * len(text)
        for i in range(len(text)):
            for j in range(i + 1, min(len(text), i + 4) + 1):
                piece = text[i:j]
                value = scores[number[piece]] if piece in number else floor if j == i + 1 else -np.inf
                top[j] = max(top[j], top[i] + value)
        return top[-1]

    texts = ["".join(rng.choice("abcx ") for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    for text, ids in zip(texts, split(codec, texts)):
        got = sum(scores[i] if i else floor for i in ids)
        assert np.isclose(got, best("▁" + text.replace(" ", "▁")))
