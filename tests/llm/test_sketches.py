"""Fingerprint sketches against sets of paragraphs in plain Python."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from sitepulse.llm import queries, sketches
from sitepulse.session import stage

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
PARAGRAPH = re.compile(r"[^.!?\n]{1,64}[.!?\n]*|[.!?\n]+")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def paragraphs(text):
    return set(PARAGRAPH.findall(text))


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """[(doc_id, n_chars, sha256, near_edited, near_next)] and the edited texts."""
    rows = [(k, t or "") for k, t in rows]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, signed(xxhash.xxh64_intdigest(r[1].encode(), 42))))
    out = []
    for i, (key, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((key, len(text), sha, round(likeness(text, edited), 9), round(likeness(text, after), 9)))
    return sorted(out, key=str)


def found(df):
    rows = df.collect()
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows), key=str), rows


def test_query_matches_brute_force(spark, sf_dir, documents):
    query = queries.op12_fingerprints(spark, sf_dir)
    assert query.columns == COLUMNS
    got, rows = found(query)
    given = documents.collect()
    assert got == expected([(r.doc_id, r.text) for r in given])
    texts = {r.doc_id: r.text or "" for r in given}
    by_text = {}
    for r in rows:
        by_text.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert sum(r.near_edited > r.near_next for r in rows) > 0.9 * len(rows)


def test_odd_rows(spark, odd_documents):
    df = odd_documents.withColumn("_row", F.lit(1)).withColumn("_text", F.lit("x"))
    got, rows = found(sketches.report(df))
    assert got == expected([(r.doc_id, r.text) for r in odd_documents.collect()])
    assert {r.fingerprint for r in rows if r.doc_id in (3, 4)} == {""}
    assert len({r.fingerprint for r in rows if r.doc_id == 1}) == 1
    assert sketches.report(df.limit(0)).count() == 0
    one = spark.createDataFrame([(5, "a b. c d. e f. g")], "doc_id bigint, text string")
    assert found(sketches.report(one))[0] == expected([(5, "a b. c d. e f. g")])


def test_long_and_many_rows_of_one_key(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(2000)]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", ".", "\n"]) for _ in range(n))
    rows = [(7, text(rng.randrange(60))) for _ in range(120)] + [(i, text(20)) for i in range(30)] + [(None, text(5)), (99, text(60_000)), (100, "é" * 300_000)]
    got, _ = found(sketches.report(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)))
    assert got == expected(rows)


def test_next_text_crosses_ranges(spark):
    rows = [(i * 3, f"t{i}") for i in range(500)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "doc_id bigint, text string").repartition(9)
    got = {r._key: (r._text, r._next) for r in sketches.with_next(df).collect()}
    assert got == {k: (t, rows[(i + 1) % 500][1]) for i, (k, t) in enumerate(rows)}


@pytest.mark.parametrize("sizes", [(0, 0, 0), (5, 0, 3), (30, 40, 500), (2000, 3, 0)])
def test_recovered_digests_are_the_differing_ones(spark, sizes):
    rng = random.Random(sum(sizes))
    draw = lambda n: [rng.getrandbits(63) for _ in range(n)]
    rows = []
    for i in range(20):
        a, b, both = (draw(n) for n in sizes)
        rows.append((i, a + both, rng.sample(both, len(both)) + b))
    df = stage(spark.createDataFrame(rows, "_row bigint, x array<bigint>, y array<bigint>"), "test-sets")
    got = sketches.differences(df, {4: ("x", "y")}).collect()
    want = {(i, d, 1) for i, a, b in rows for d in set(a) - set(b)} | {(i, d, 2) for i, a, b in rows for d in set(b) - set(a)}
    assert {(r._row, r._digest, r._side) for r in got} == want and len(got) == len(want)
    counted = sketches.difference_sizes(df, {4: ("x", "y")}).collect()
    assert {(r._row, r._first, r._second) for r in counted} == {(i, sizes[0], sizes[1]) for i in range(20) if sizes[0] + sizes[1]}


def test_only_native_steps_and_one_shuffle_by_row(spark, documents):
    rows = stage(documents.select(F.col("doc_id").alias("_row"), sketches.digests(F.col("text")).alias("_a"), sketches.digests(F.lower("text")).alias("_b")), "test-native")
    given = rows.repartition("_row").selectExpr("_row", "0 AS _kind", "9L AS _width", "_a", "_b")
    plan = sketches.peeled(sketches.subtracted(given))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan


def test_digests_an_edited_text_shares_are_stored_once(spark, monkeypatch):
    kept = {}

    def keep(df, name):
        kept[name] = stage(df, name)
        return kept[name]

    monkeypatch.setattr(sketches, "stage", keep)
    rows = [(i, ". ".join(f"sentence {i} {j}" for j in range(40))) for i in range(8)]
    got, _ = found(sketches.report(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert got == expected(rows)
    sizes = kept["versions"].selectExpr("size(_a) AS a", "size(_b) AS b").collect()
    assert all(r.a == 40 and r.b < 15 for r in sizes)


def test_shared_start(spark):
    pairs = [([], [], 0), ([1], [], 0), ([], [1], 0), ([1, 2], [1, 2], 2), ([1, 2], [1, 2, 3], 2), ([1, 2, 3], [1, 9, 3], 1), ([5], [6], 0)]
    df = spark.createDataFrame(pairs, "a array<bigint>, b array<bigint>, n int")
    assert all(r.n == r.found for r in df.withColumn("found", sketches.shared_start(F.col("a"), F.col("b"))).collect())
