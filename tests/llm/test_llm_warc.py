"""WARC archives: written, normalised and read back."""

import gzip
import hashlib
import zlib

import pytest

from wardflow import scratch
from wardflow.llm import warc

BIG = "ä<p>\r\n\r\nWARC/1.1\r\n" * 20000
PAGES = [(3, "http://a/", "x" * 100), (1, "http://b/", "x" * 100), (2, None, "x" * 99), (4, "u\r\nInjected: 1", "x" * 99), (5, "u", None),
         (6, "u", ""), (7, "u", "\r\n\r\n"), (8, "u", BIG), (9, "u", BIG), (None, "u", BIG), (10, "u", "é" * 50), (11, "u", "é" * 50),
         (12, "u", "\0\x1f\x8b"), (1, "http://b/", "x" * 100)]


def expected():
    out = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        first = min((j for j, _, h in PAGES if h == html and j is not None), default=None) if len(body) >= 100 else None
        revisit = first is not None and i != first
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("records", [1, 3, 1000])
def test_round_trip(spark, monkeypatch, records):
    monkeypatch.setattr(warc, "BLOCK", 1 << 12)
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, value string")
    raw, normal = scratch.new_path(spark, "t"), scratch.new_path(spark, "t")
    warc.write_archives(df, raw, records=records)
    warc.normalise(spark, raw, normal)
    got = []
    for r in warc.read_archives(spark, normal).collect():
        h, body = r.headers, bytes(r.payload)
        assert int(h["Content-Length"]) == len(body) and "Injected" not in h
        number = lambda name, h=h: int(h[name]) if name in h else None
        if h["WARC-Type"] == "response":
            assert h["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(body).hexdigest()
        got.append((number("X-Page-Key"), number("X-Payload-Length"), h["WARC-Payload-Digest"][7:], h["WARC-Type"],
                    number("X-Refers-To-Key")))
    assert sorted(got, key=str) == expected()
    # A normalised archive is a plain multi-member gzip file; every index entry is one member.
    files = spark.read.format("binaryFile").load(normal).collect()
    archives = {f.archive: bytes(f.content) for f in files if f.kind == "warc"}
    for f in files:
        if f.kind == "cdx":
            whole, at = archives[f.archive], 0
            for line in gzip.decompress(bytes(f.content)).decode().splitlines():
                offset, length = map(int, line.split())
                assert offset == at
                one = zlib.decompressobj(31)
                record = one.decompress(whole[offset:offset + length])
                assert one.eof and not one.unused_data and record.startswith(b"WARC/1.1") and record.endswith(b"\r\n\r\n")
                at += length
            assert at == len(whole)


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    raw, normal = scratch.new_path(spark, "t"), scratch.new_path(spark, "t")
    warc.write_archives(df, raw)
    warc.normalise(spark, raw, normal)
    assert warc.read_archives(spark, normal).count() == 0


def test_streams():
    one = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert list(warc.records_of(gzip.compress(one) + gzip.compress(one * 2))) == [one] * 3
    for bad in (gzip.compress(one)[:-9], gzip.compress(one[:-1]), gzip.compress(b"HTTP" + one)):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.records_of(bad))


def test_members_end_with_a_zero_byte():
    for size in (0, 10, (1 << 24) + 3):
        packed = warc.member(bytes(size))
        assert packed[-1] == 0 and gzip.decompress(packed) == bytes(size)
