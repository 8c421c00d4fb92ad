"""SimHash groups against all pairs in plain Python."""

import random
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from sitepulse.llm import queries, simhash


def expected(rows):
    fp = [brute.fingerprint(text) for _, text in rows]
    comp = brute.components(set(fp), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (key, _), f in zip(rows, fp):
        if key is not None:
            least[comp[f]] = min(key, least.get(comp[f], key))
    return Counter((key, f"{f:016x}", least.get(comp[f])) for (key, _), f in zip(rows, fp))


def found(df):
    return Counter(
        tuple(r) for r in df.select("doc_id", simhash.hexadecimal(F.col("fp0")), "component_id").collect()
    )


def test_query_matches_brute_force(spark, sf_dir, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert Counter(map(tuple, queries.op5_simhash(spark, sf_dir).collect())) == expected(rows)


def test_odd_rows(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert found(simhash.near_duplicates(odd_documents)) == expected(rows)


def test_empty_table(odd_documents):
    empty = odd_documents.limit(0)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.one_of_each(empty).count() == 0


def test_links_miss_nothing(spark):
    """Every pair within the distance is joined, also in buckets that are cut into blocks."""
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = {0}
    for i in range(600):
        x = centres[i % 6]
        for b in rng.sample(range(64), rng.randint(0, 6)):
            x ^= 1 << b
        prints.add(x)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    df = spark.createDataFrame(signed, "fp0 bigint")
    truth = brute.components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    for block in (4096, 16):
        old, simhash.buckets.blocks.__defaults__ = simhash.buckets.blocks.__defaults__, (block,)
        try:
            groups = simhash.grouped(df, simhash.NEAR).collect()
        finally:
            simhash.buckets.blocks.__defaults__ = old
        by = {}
        for r in groups:
            by.setdefault(r._group, set()).add(r.fp0 & (1 << 64) - 1)
        want = {}
        for x, c in truth.items():
            want.setdefault(c, set()).add(x)
        assert sorted(map(sorted, by.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("partitions", [8, 64])
def test_forest_rows_do_not_grow_with_the_tasks(spark, partitions, monkeypatch):
    """A large group of near copies: rows that leave the spanning step, against its fingerprints."""
    rng = random.Random(7)
    centre = rng.getrandbits(63)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 2))) for _ in range(700)}
    emitted = spark.sparkContext.accumulator(0)
    spanned = simhash.graph.forest

    def counted(batches):
        for batch in spanned(batches):
            emitted.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(simhash.graph, "forest", counted)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    settings = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        groups = simhash.grouped(spark.createDataFrame([(x,) for x in prints], "fp0 bigint"), simhash.NEAR).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r._group for r in groups}) == 1
    rounds = 4
    assert emitted.value <= 2 * rounds * len(prints)


def test_one_of_each_keeps_clean_rows(spark, odd_documents):
    kept = simhash.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    # The lower-case twins are one group, and so are the texts without words and the long pair.
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 3), (False, 5), (False, 7), (True, 0),
    ]


def test_one_document_of_each_group_stays(spark, documents, sf_dir):
    """The pipeline's stage keeps the smallest key of every group of the query, and nothing else."""
    kept = sorted(r.doc_id for r in simhash.one_of_each(documents).collect())
    groups = queries.op5_simhash(spark, sf_dir).collect()
    assert kept == sorted({r.component_id for r in groups})


def test_which_row_of_a_group_stays(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(None, text, "a"), (7, text, "b"), (3, text.upper(), "c"), (3, text, "d"), (None, "x", "e"), (None, "x", "f"), (9, "y", "g")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string, _row string")).collect()
    assert sorted((r.doc_id or 0, r.text.lower()) for r in kept) == [(0, "x"), (3, text), (9, "y")]
