"""Feeds of hostile and odd forms, packed bodies, indexes that point at each other, bodies in pieces."""

import gzip
import hashlib
import time

import pytest

from annalist.functions import feeds
from annalist.sources import registry


def test_odd_entries():
    text = """<?xml version='1.0'?><!DOCTYPE rss [<!ENTITY a "x>y">]><rss xmlns:m="u"><channel><image><url>no</url></image>
    <item><title>One &amp; <![CDATA[<b>&amp;</item>]]></title><link>https://x.example/1</link><m:link>https://x.example/no</m:link><guid>g</guid>
    <item><description>a > b</description><link/><title></title><link>https://x.example/2</link><dc:date>d</dc:date></item>
    <entry><link rel="self" href="https://x.example/self"/><link href='https://x.example/3?a=1&amp;b=">"' data-x=y/><source><title>no</title></source><title>T</title></entry>
    <entry><link rel="enclosure" href="https://x.example/e"/></entry><url><loc>https://x.example/4</loc></url><item><link>https://x.example/5"""
    assert list(feeds.entries(text)) == [
        ("item", "https://x.example/1", "One & <b>&amp;</item>", None),
        ("item", "https://x.example/2", None, "d"),
        ("item", 'https://x.example/3?a=1&b=">"', "T", None),
        ("url", "https://x.example/4", None, None),
    ]
    assert list(feeds.entries(None)) == list(feeds.entries("")) == list(feeds.entries("plain < text")) == []


@pytest.mark.parametrize("piece", ["<item>", "<item><title>", "<a '", "<a \"", "<!--", "<![CDATA[", "<item><link href='x' ", "<a b c ", "<", "<item><x y='", "&#", "<!DOCTYPE ["])
def test_hostile_feeds_take_linear_time(piece):
    text = piece * (20_000_000 // len(piece) // 8)
    began = time.perf_counter()
    list(feeds.entries(text))
    half = time.perf_counter()
    list(feeds.entries(text[: len(text) // 4]))
    assert half - began < 20 and (half - began) < 12 * (time.perf_counter() - half) + 1


def test_members_and_bombs():
    body = b"<urlset>" + b"x" * 100
    packed = gzip.compress(body[:40]) + gzip.compress(body[40:]) + b"\0\0"
    assert feeds.unpacked(packed, 1_000) == feeds.unpacked(body, 1_000) == body and feeds.unpacked(b"", 10) == b""
    for content, most, code in ((body, 50, "body_too_large"), (packed, 50, "body_too_large"), (gzip.compress(b"0" * 10**7), 10**8, "decompression_bomb"), (packed[:-6], 1_000, "content_decoding_error"), (b"\x1f\x8bnothing", 1_000, "content_decoding_error")):
        with pytest.raises(feeds.Packed, match=code):
            feeds.unpacked(content, most)


def test_files_and_errors(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<urlset><url><loc>https://x.example/1</loc></url></urlset>")
    (tmp_path / "b.xml.gz").write_bytes(gzip.compress(b"<urlset><url><loc>https://x.example/2</loc></url></urlset>"))
    (tmp_path / "c.xml.gz").write_bytes(b"\x1f\x8bbroken")
    got = {r["path"][-8:]: (r["url"], r["error"]) for r in registry.read_feeds(spark, str(tmp_path)).collect()}
    assert sorted(got.values(), key=str) == [("https://x.example/1", None), ("https://x.example/2", None), (None, "content_decoding_error")]


def test_indexes_expand(spark):
    index = lambda *urls: "<sitemapindex>" + "".join(f"<sitemap><loc>{u}</loc></sitemap>" for u in urls) + "</sitemapindex>"
    leaf = lambda *urls: "<urlset>" + "".join(f"<url><loc>{u}</loc></url>" for u in urls) + "</urlset>"
    documents = spark.createDataFrame([("r", index("a", "b", "gone")), ("a", index("r", "b", "a")), ("b", leaf("p1", "p2")), ("other", leaf("q"))], "url string, body string")
    got = registry.expanded_sitemaps(spark.createDataFrame([("r",), ("b",), ("no",)], "root string"), documents)
    assert sorted((r["root"], r["url"], r["level"]) for r in got.collect()) == [("b", "p1", 0), ("b", "p2", 0), ("r", "p1", 1), ("r", "p2", 1)]


def test_bodies_in_pieces(spark):
    bodies = {"a": [b"one", b"two"], "b": [b"x"], "c": [b"y" * 30], "d": [b"1", b"2"], "e": []}
    sha = lambda parts: hashlib.sha256(b"".join(parts)).hexdigest()
    expected = spark.createDataFrame([(k, sha(v), len(v)) for k, v in bodies.items()] + [("f", sha([b"q"]), 1), ("g", sha([b"z", b"z"]), 2)], "key string, sha256 string, pieces int")
    chunks = [(k, n, c) for k, v in bodies.items() for n, c in enumerate(v)] + [("f", 0, b"w"), ("g", 0, b"z"), ("g", 0, b"z"), ("unexpected", 0, b"")]
    chunks = [c for c in chunks if c[:2] != ("d", 1)]
    got = registry.verified_chunks(spark.createDataFrame(chunks, "key string, seq int, content binary").repartition(3), expected, 20)
    assert {r["key"]: r["status"] for r in got.collect()} == {"a": "ok", "b": "ok", "c": "too_large", "d": "incomplete", "e": "missing", "f": "mismatch", "g": "incomplete"}
