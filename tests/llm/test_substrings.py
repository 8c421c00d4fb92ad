"""Repeated windows against counting every window in plain Python."""

import hashlib
import random
from collections import Counter

import brute
import pytest

from sitepulse.llm import queries, substrings


def expected(rows, window=35):
    split = [(key, brute.words(text)) for key, text in rows]
    seen = Counter(tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1))
    out = []
    for key, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def found(df):
    return Counter(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()))


def test_query_matches_brute_force(spark, documents, sf_dir):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = expected(rows)
    assert any(r[2] for r in want)
    assert found(queries.op10_substrings(spark, sf_dir)) == want


def test_odd_rows(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert found(substrings.report(odd_documents)) == expected(rows)
    assert substrings.report(odd_documents.limit(0)).count() == 0


@pytest.mark.parametrize("shard", [512, 3])
def test_planted_repeats(spark, shard):
    """Passages, periodic texts and copies; with small shards most anchors take the way of frequent ones."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(40):
        w = [f"v{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 200))]
        at = rng.randrange(len(w))
        if i % 3 == 0:
            w[at:at] = passage[rng.randrange(0, 10) : rng.randrange(40, 60)]
        if i % 10 == 4:
            w = w + w[:50]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(100, "a b " * 40), (101, "c " * 50), (102, "d " * 35), (103, "e " * 34), (104, rows[0][1]), (104, rows[0][1])]
    rows += [(None, rows[1][1] + " tail"), (105, " ".join(passage[:35])), (106, " ".join(passage[3:37]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(substrings.report(docs, shard=shard)) == expected(rows)


def test_cleaned_leaves_other_texts_alone(spark):
    block = " ".join(f"b{i}" for i in range(60))
    rows = [
        (1, f"first  text\n{block} end", "x", 9, 1),
        (2, f"{block}", "x", 9, 2),
        (3, "a  clean\ttext", None, 13, 3),
        (4, None, "x", None, 4),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _row string, n_chars bigint, _t0 int")
    got = {r.doc_id: tuple(r) for r in substrings.cleaned(docs).collect()}
    assert got == {1: (1, "first text end", "x", 14, 1), 2: (2, "", "x", 0, 2), 3: rows[2], 4: rows[3]}


def test_automaton_counts_every_place():
    rng = random.Random(8)
    for _ in range(60):
        texts = [[rng.choice([b"x", b"y"]) for _ in range(rng.randrange(1, 12))] for _ in range(3)]
        automaton = substrings.Automaton()
        for t in texts:
            automaton.add(t, 1)
        automaton.close()
        for least in (2, 3):
            seen = Counter(tuple(t[i : i + least]) for t in texts for i in range(len(t) - least + 1))
            for t in texts:
                want = set()
                for i in range(len(t) - least + 1):
                    if seen[tuple(t[i : i + least])] > 1:
                        want.update(range(i, i + least))
                got = {i for lo, hi in automaton.repeated(t, least) for i in range(lo, hi)}
                assert got == want
