"""Spelling variants against all pairs in plain Python; the gram bounds against real edits."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from sitepulse.llm import buckets, queries, spelling

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def variants(counts):
    """{word: (form, root, n, n_near, form_n)} by comparing words that share a deletion."""
    by_deletion = {}
    for w in counts:
        if len(w) > 1000:
            by_deletion.setdefault("long", set()).add(w)
            continue
        for x in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            by_deletion.setdefault(x, set()).add(w)
    others = {w: set() for w in counts}
    for group in by_deletion.values():
        for a, b in itertools.combinations(group, 2):
            if near(a, b):
                others[a].add(b)
                others[b].add(a)
    form = {}
    for w, n in counts.items():
        best = min(others[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 10 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(others[w]), counts[form[w]] if form[w] else None)
    return out


def expected(rows):
    counts = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return variants({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})


def found(df):
    assert df.columns == COLUMNS
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_matches_brute_force(spark, sf):
    path = f"/root/testdata/sf{sf}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    want = expected(rows)
    assert found(queries.op11_spelling(spark, path)) == want
    assert sum(x[0] is not None for x in want.values()) > 5


@pytest.mark.parametrize("block", [4096, 16])
def test_dense_words(spark, block, monkeypatch):
    """Many words of few letters, in lists that are cut into blocks; counts that make chains of forms."""
    rng = random.Random(block)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(7, 12))) for _ in range(900)}
    words |= {"aaaaaaa" + "b" * k for k in range(5)} | {"x" * k for k in (70, 71, 300)} | {"x" * 69 + "y", "x" * 150 + "z" + "x" * 149}
    counts = {w: 10 ** rng.randrange(6) * rng.randrange(1, 4) for w in sorted(words)}
    monkeypatch.setattr(buckets.blocks, "__defaults__", (block,))
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert found(spelling.variants(df)) == variants(counts)


def test_odd_rows(spark, odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    more = [(20, "Étranger étranger ÉTRANGER étranges×étrange"), (21, "abcdefghij " * 40), (22, "abcdefghi " * 3), (None, "abcdefghij abcdefgh abcdefgh")]
    unbroken = "lettersonly" * 5_000
    more += [(23, unbroken), (24, unbroken), (25, unbroken + "s"), (26, unbroken + "s")]
    kind = "doc_id bigint, text string, word int"
    df = spark.createDataFrame([(k, t, 1) for k, t in rows + more], kind)
    got = found(spelling.report(df))
    want = expected(rows + more)
    assert got == want
    assert found(spelling.report(df.limit(0))) == {}


@pytest.mark.parametrize("size", range(7, 13))
def test_an_edit_leaves_a_gram_of_any_long_word(size):
    """Every decomposition that a dictionary can give a word."""
    word, most = "abcdefghijklm"[:size], spelling.longest(size)
    picks = itertools.product(*(range(2, min(most, size - p) + 1) for p in range(size - 1)))
    for lengths in itertools.islice(picks, 0, None, 1 if size < 10 else 37):
        grams = spelling.decomposed(word, frozenset(word[p : p + k] for p, n in enumerate(lengths) for k in range(2, n)), most)
        assert len(grams) > spelling.bound(grams, size, most)


def test_near_words_meet_in_the_lists_of_a_long_one():
    """Whatever the dictionary, real edits leave one of the rarest grams of a long word where the lists expect it."""
    rng = random.Random(8)
    for _ in range(6000):
        letters = rng.choice(["ab", "abc", "abcdefgh"])
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(7, 15)))
        at = rng.randrange(len(word) + 1)
        other = rng.choice([word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]])
        long, short = (word, other) if len(word) >= len(other) else (other, word)
        if long == short:
            continue
        chance, frequent = rng.random(), {}
        for k in range(2, 8):
            for w in (word, other):
                for i in range(len(w) - k + 1):
                    g = w[i : i + k]
                    if (k == 2 or g[:-1] in frequent) and rng.random() < chance:
                        frequent[g] = rng.randrange(3)
        size = len(long)
        most = spelling.longest(size)

        def lists(w):
            grams = spelling.decomposed(w, frequent, most)
            ranked = sorted((frequent.get(w[a : b + 1], 0), a, b) for a, b in grams)
            return grams, {(w[a : b + 1], a) for _, a, b in ranked[: spelling.bound(grams, len(w), most) + 1]}

        _, own = lists(long)
        grams, others = lists(short)
        if len(short) < size:
            others = {(short[a : b + 1], p) for a, b in grams for p in (a, a + 1)}
        assert own & others
