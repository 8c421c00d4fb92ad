"""ARC lines of both versions, WARC records and files, and the pages query by brute force."""

import base64
import gzip
import hashlib

import pytest

from sitepulse.llm import arc, queries

RECORDS = [
    arc.ArcRecord("http://a.example/x y", "1.2.3.4", "20010203040506", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\n", "200"),
    arc.ArcRecord("dns:a.example", "1.2.3.4", "20010203", "text/dns", b"20010203 a.example 1.2.3.4\n"),
    arc.ArcRecord("http://b.example/", "-", "20011231235959", "text/plain", b""),
    arc.ArcRecord("http://c.example/", "-", "20011231235959", "no type", b"HTTP/1.1 200 OK\n\nends\r\n\r\n", "404"),
]


def archive(version):
    return arc.arc_header(version, "old.arc", "20010101000000") + b"".join(arc.arc_record(version, r) for r in RECORDS)


@pytest.mark.parametrize("version", [1, 2])
def test_parses_both_versions(version):
    got = list(arc.parse_arc(archive(version)))
    assert [r.block for r in got] == [r.block for r in RECORDS]
    assert [r.url for r in got] == ["http://a.example/x%20y", *(r.url for r in RECORDS[1:])]
    assert [r.date for r in got] == ["20010203040506", "20010203000000", "20011231235959", "20011231235959"]
    assert [r.content_type for r in got] == ["text/html", "text/dns", "text/plain", "no%20type"]
    assert [r.status for r in got] == ([None] * 4 if version == 1 else ["200", None, None, "404"])


def test_urls_with_spaces_and_bad_lines():
    line = b"http://a/b c d 1.2.3.4 20200101 text/html 3\nabc\n"
    (record,) = arc.parse_arc(line, 1)
    assert (record.url, record.block) == ("http://a/b c d", b"abc")
    for bad in (b"http://a 1 20200101 text/html 9\nabc\n", b"http://a 1 text/html 3\nabc\n", b"http://a 1 x text/html 3\nabc",
                b"no end", b"u 1 20200101 t -1\n", b"filedesc://x 0 20200101 t 4\n9 0 \n"):
        with pytest.raises(arc.ArcError):
            list(arc.parse_arc(bad, None if bad.startswith(b"filedesc") else 1))


def test_warc_records_survive_cuts():
    bodies = [b"", b"\r\n", b"x\r\n", b"\r\n\r\n", b"a\r\n\r\nb\r\n\r\n\r\n", b"\r", b"WARC/1.1\r\n\r\n"]
    data = b""
    for i, body in enumerate(bodies):
        record = arc.ArcRecord("http://a/", "-", "20200101000000", "text/html", b"")
        data += arc.warc_record(record, b"HTTP/1.1 200 OK\r\n\r\n", body, arc.digest(body), i) + arc.END
    pieces = data.split(arc.END)
    for cut in (pieces, pieces[:-1] if not pieces[-1] else pieces):
        got = list(arc.parse_warc(iter(cut)))
        assert [b.split(arc.END, 1)[1] for _, b in got] == bodies
        assert [int(h["WARC-Source-Id"]) for h, _ in got] == list(range(len(bodies)))
    with pytest.raises(ValueError):
        list(arc.parse_warc(iter(pieces[:1])))


def test_files_are_converted(spark, tmp_path):
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "one.arc.gz").write_bytes(gzip.compress(archive(1)))
    (tmp_path / "arc" / "two.arc").write_bytes(archive(2))
    arcs = arc.read_arc(spark, str(tmp_path / "arc"))
    arc.write_warc(arcs, str(tmp_path / "warc"), least_bytes=1)
    rows = arc.read_warc(spark, str(tmp_path / "warc")).collect()
    assert sorted(r.record_type for r in rows) == ["resource"] * 2 + ["response"] * 6
    assert sorted(r.payload for r in rows) == sorted([b"body\n", RECORDS[1].block, b"", b"ends\r\n\r\n"] * 2)
    assert {r.date for r in rows} == {"2001-02-03T04:05:06Z", "2001-02-03T00:00:00Z", "2001-12-31T23:59:59Z"}
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "warc").glob("*.gz"))
    assert raw.count(b"WARC/1.1\r\n") == 8 and raw.endswith(arc.END)


def brute(rows, least=0):
    first = {}
    for key, body in rows:
        data = (body or "").encode()
        if len(data) >= least and key is not None:
            first[data] = min(key, first.get(data, key))
    out = []
    for key, body in rows:
        data = (body or "").encode()
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        to = first.get(data)
        revisit = to is not None and to != key
        out.append((key, len(data), sha, "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def test_query_matches_brute_force(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = queries.op2_archive(spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == brute([(r.page_id, r.html) for r in pages])


@pytest.mark.parametrize("least", [0, 5])
def test_odd_pages(spark, least):
    rows = [
        (3, "http://a/", "same text"), (1, "http://b/ x", "same text"), (2, None, None), (7, "dns:x", ""), (None, "http://c/", "é\r\n\r\n"),
        (4, "http://d/", "é\r\n\r\n"), (9, "http://e/", "\r\n"), (9, "http://e/", "\r\n"), (10, "http://f/", "x" * 3_000_000),
        (11, "a\nb", "WARC/1.1\r\n\r\n"), (None, "http://g/", "only null"),
    ]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id bigint, url string, html string, head string")
    got = arc.archived(pages, least_bytes=least).collect()
    assert sorted(map(tuple, got), key=str) == brute([(k, h) for k, _, h in rows], least)
    assert arc.archived(pages.limit(0)).count() == 0


def test_identifiers_are_the_same_on_every_run():
    r = RECORDS[0]
    assert arc.warc_id("response", r, "D") == arc.warc_id("response", r, "D") != arc.warc_id("revisit", r, "D")
