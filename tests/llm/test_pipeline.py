"""Stages in turn: columns, decisions that take effect, clean documents kept."""

import random
from collections import Counter

import brute

import corpus_pipeline
from sitepulse.llm import pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_planted_cases(spark, sf_dir, tmp_path):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 5)))
    passage = [word() for _ in range(60)]
    rows, toxic = [], set()
    for i in range(300):
        w = [word() for _ in range(rng.randrange(150, 260))]
        if i < 60:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["zgroble", "vexnub"]))
            toxic.add(i)
        elif i < 90:
            at = rng.randrange(len(w))
            w[at:at] = passage
        rows.append((i, " ".join(w)))
    near = []
    for i in range(200, 220):
        w = rows[i][1].split(" ")
        w[rng.randrange(len(w))] = "changed"
        near.append((1000 + i, " ".join(w)))
    exact = [(2000 + i, rows[i][1]) for i in range(230, 240)]
    rows += near + exact
    docs = [(i, t, "en", f"src{i % 4}", len(t)) for i, t in rows]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(docs, kind).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(200)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    by_stage, now = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        by_stage[name] = now.collect()
        if k + 1 < len(corpus_pipeline.STAGES):
            assert now.columns == COLUMNS
    given = {i for i, _ in rows}
    clean = given - toxic
    assert {r.doc_id for r in by_stage["toxicity"]} == clean
    prints = {i: brute.fingerprint(t) for i, t in rows if i in clean}
    groups = brute.components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    stay = {}
    for i, p in sorted(prints.items()):
        stay.setdefault(groups[p], i)
    assert {r.doc_id for r in by_stage["near_duplicates"]} == set(stay.values())
    assert not {i for i, _ in exact} & set(stay.values()) and clean - {i for i, _ in near + exact} <= set(stay.values())
    texts = {r.doc_id: r.text for r in by_stage["repeated_passages"]}
    before = dict(rows)
    assert set(texts) == {r.doc_id for r in by_stage["near_duplicates"]}
    for i, text in texts.items():
        assert ("".join(passage) in text.replace(" ", "")) is False
        if i >= 90 and not 200 <= i % 1000 < 220:  # near copies that stay share passages
            assert text == before[i]
    mixed = by_stage["mixing"]
    assert max(Counter(r.doc_id for r in mixed).values()) <= 3
    sizes = Counter()
    for r in mixed:
        sizes[r.source] += len(brute.words(r.text))
    assert sizes["src0"] > sizes["src1"] > sizes["src2"]
    codec = pieces.Codec(pieces.load())
    assert sorted(codec.decode(r.ids) for r in by_stage["pieces"]) == sorted(r.text for r in mixed)
    assert all(r.n_tokens == len(r.ids) for r in by_stage["pieces"])


def test_run_over_given_tables(spark, sf_dir, documents):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "lang", "source", "ids", "n_tokens"]
    assert {r.doc_id for r in got.select("doc_id").collect()} <= {r.doc_id for r in documents.collect()}


def test_odd_rows_pass_every_stage(spark, odd_documents, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows, an empty table."""
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(r.doc_id, r.text, None if i % 2 else "en", r.source, r.n_chars) for i, r in enumerate(odd_documents.collect())]
    unbroken = "abc" * 20_000
    rows += [(8, unbroken, "en", "a", None), (9, unbroken + " x", None, None, 1)]
    labels = spark.createDataFrame([(1, 1, None), (2, None, 0), (None, 0, 1), (7, 1, 1)], "doc_id bigint, quality int, toxic int")
    for name, given in (("odd", rows), ("none", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(given, kind).write.parquet(f"{folder}/documents.parquet")
        labels.filter("false" if not given else "true").write.parquet(f"{folder}/labels.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        assert {r.doc_id for r in got} <= {r[0] for r in given}
        assert bool(got) == bool(given)
