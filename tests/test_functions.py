import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sitepulse.functions import jsoncols, rum, scalar, text, weburl


def one(spark, column, **values):
    rows = spark.range(1)
    if values:
        schema = ", ".join(f"{n} {t}" for n, (t, _) in values.items())
        rows = spark.createDataFrame([tuple(v for _, v in values.values())], schema)
    return rows.select(column).first()[0]


def cost(char):
    """Bytes of one character by the published rule."""
    code = ord(char)
    size = len(char.encode("utf-8", "surrogatepass"))
    if char in '\\"/':
        return size + 2
    if char in "\b\t\n\f\r":
        return size + 1
    if code < 0x20:
        return size + 3 + len("000" + format(code, "x"))
    return size


def cut(value, budget):
    used = 0
    for i, char in enumerate(value):
        used += cost(char)
        if used > budget:
            return value[:i]
    return value


def test_fit_json_bytes(spark):
    @settings(max_examples=30, deadline=None)
    @given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=1, max_size=20), st.integers(0, 60))
    def check(values, budget):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        got = frame.select("i", text.fit_json_bytes(F.col("v"), F.lit(budget)).alias("c")).collect()
        assert {r.i: r.c for r in got} == {i: cut(v, budget) for i, v in enumerate(values)}

    check()
    everything = "".join(chr(c) for c in (*range(0x80), 0x7FF, 0x800, 0xFFFD, 0x1F600)) * 2
    for budget in range(0, 400, 37):
        assert one(spark, text.fit_json_bytes(F.col("v"), F.lit(budget)), v=("string", everything)) == cut(everything, budget)


def test_drop_json_member(spark):
    doc = json.dumps({"b": 1.0, "response": {"content": {"text": "x", "é": "é"}}})

    def dropped(value):
        rows = spark.createDataFrame([(value,)], "v string")
        return text.drop_json_member(rows, "out", F.col("v"), "response", "content", "text", require_parent=True).first().out

    assert dropped(doc) == '{"b":1.0,"response":{"content":{"é":"é"}}}'
    for bad in ("{", "[]", "{}", '{"response":{}}', None):
        assert dropped(bad) is None


@pytest.mark.parametrize("doc, value", [('{"a":{"x.y-z":1.5}}', 1.5), ('{"a":{"x.y-z":"1.5"}}', None), ('{"a":1}', None), ("{", None)])
def test_float64(spark, doc, value):
    assert one(spark, jsoncols.float64(F.col("v"), "a", "x.y-z"), v=("string", doc)) == value


def test_other_json_reads(spark):
    assert one(spark, jsoncols.int64(F.col("v"), "a"), v=("string", '{"a":3.0}')) == 3
    assert one(spark, jsoncols.int64(F.col("v"), "a"), v=("string", '{"a":3.5}')) is None
    assert one(spark, jsoncols.string_at(F.col("v"), "a"), v=("string", '{"a":true}')) == "true"
    assert one(spark, jsoncols.array_at(F.col("v"), "a"), v=("string", '{"a":["x",null]}')) == ["x", None]
    assert one(spark, jsoncols.array_at(F.col("v"), "a"), v=("string", '{"a":{}}')) is None
    assert [one(spark, jsoncols.is_present(F.col("v")), v=("string", d)) for d in ("{}", " { }", '{"a":1}', None)] == [False, False, True, False]
    wide = ["{" + " " * 1500 + "}", "\n" * 1500 + "{}\n", "{" + " " * 1500 + '"a":1}']
    assert [one(spark, jsoncols.is_present(F.col("v")), v=("string", d)) for d in wide] == [False, False, True]


def test_scalars(spark):
    assert [one(spark, scalar.round_to_int(F.col("v")), v=("double", x)) for x in (2.5, -2.5, 2.4)] == [3, -3, 2]
    assert one(spark, scalar.bucket(F.col("v"), 10240, 10), v=("double", 20480.0)) == 20
    assert one(spark, scalar.safe_divide(F.lit(1), F.lit(0))) is None
    assert one(spark, scalar.month_label(F.lit(202402))) == "2024_02_01"
    assert one(spark, scalar.epoch_ms(F.to_date(F.lit("2300-01-01")))) == 10413792000000
    assert one(spark, scalar.drop_last_char(F.lit("https://a/"))) == "https://a"
    assert one(spark, scalar.shard_date(F.lit("18_03_01_desktop"))) == "2018_03_01"
    assert str(one(spark, scalar.parse_report_date(F.lit("2018_03_01")))) == "2018-03-01"
    import hashlib

    for url in ("http://a/", "http://é/"):
        expected = int(hashlib.sha256(url.encode()).hexdigest(), 16) % 4
        assert one(spark, scalar.url_shard(F.lit(url))) == expected


def test_spread_edges(spark):
    def spread(start, end, density=1.0):
        column = rum.spread(F.col("s"), F.col("e"), F.col("d"), F.lit(100), F.lit(5000), "bigint")
        return [tuple(r) for r in one(spark, column, s=("bigint", start), e=("bigint", end), d=("double", density))]

    assert spread(0, 150) == [(0, 1 / 1.5), (100, 1 / 1.5)]
    assert spread(0, None) == spread(5, 5) == spread(9, 3) == []
    assert spread(None, 100) == [(0, 1.0)]
    assert len(spread(100, 99999)) == 50


@pytest.mark.parametrize("url, host, domain, sub, path", [
    ("http://www.a.co.uk/x?y", "www.a.co.uk", "a.co.uk", "www", "/x"), ("https://u:p@A.b.com:80", "a.b.com", "b.com", "a", "/"),
    ("http://10.0.0.1/", "10.0.0.1", "10.0.0.1", "", "/"), ("http://localhost#f", "localhost", "localhost", "", "/"),
])
def test_urls(spark, url, host, domain, sub, path):
    u = F.lit(url)
    assert one(spark, F.array(weburl.host(u), weburl.registered_domain(u), weburl.subdomain(u), weburl.path(u))) == [host, domain, sub, path]


def without(text, *path, require_parent=False):

    root = json.loads(text)
    if not isinstance(root, dict) or not root:
        return None
    node = root
    for key in path[:-1]:
        node = node.get(key) if isinstance(node, dict) else None
    if not isinstance(node, dict):
        return None if require_parent else root
    node.pop(path[-1], None)
    return root


def test_json_members_are_cut_out(spark):
    """Nested, reordered, escaped, repeated, missing and misleading members, against a parser."""
    import random


    rng = random.Random(4)
    hard = ['a"b', "back\\slash", "é漢\n", '"text":"x"', "}],{", "", "x" * 300, '{"content":{"text":1}}']

    def value(depth):
        kind = rng.randrange(7 if depth else 4)
        if kind < 3:
            return rng.choice([rng.choice(hard), rng.randrange(-5, 10**6), 1.5, True, False, None])
        if kind == 3:
            return rng.choice(hard)
        if kind == 4:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return {rng.choice(["text", "a", "b c", "content", 'q"']): value(depth - 1) for _ in range(rng.randrange(4))}

    def shuffled(members):
        rng.shuffle(members)
        return dict(members)

    docs = []
    for _ in range(300):
        content = shuffled([("text", rng.choice(hard)), *((f"k{i}", value(rng.randrange(6))) for i in range(rng.randrange(4)))])
        response = shuffled([("content", rng.choice([content, content, content, "{text", None, 3])), ("h", value(2))])
        docs.append(shuffled([("response", rng.choice([response, response, response, [1], None])), ("u", value(2)), ("copy", rng.choice([response, 1]))]))
    docs += [{}, {"response": {"content": {}}}, {"response": {"content": {"text": "only"}}}, {"response": {"content": {"x": 1}}}, {"a": 1}]
    texts = [json.dumps(d, separators=(",", ":"), ensure_ascii=False) for d in docs] + ["[1]", "3"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, doc string")
    for strict in (False, True):
        cut = text.drop_json_member(rows, "cut", F.col("doc"), "response", "content", "text", require_parent=strict)
        got = {r.i: r.cut for r in cut.collect()}
        for i, t in enumerate(texts):
            want = without(t, "response", "content", "text", require_parent=strict)
            assert (got[i] is None) == (want is None) and (want is None or json.loads(got[i]) == want), t
    # What the pattern reaches keeps its order and its text.
    plain = '{"b":1,"response":{"z":"é\\"","content":{"size":3,"text":"a\\"}{","n":1.5}},"a":[1,2]}'
    kept = text.drop_json_member(spark.createDataFrame([(plain,)], "doc string"), "cut", F.col("doc"), "response", "content", "text").first().cut
    assert kept == '{"b":1,"response":{"z":"é\\"","content":{"size":3,"n":1.5}},"a":[1,2]}'
