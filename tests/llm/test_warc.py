from __future__ import annotations

import hashlib

import pytest

from claimlake.llm import warc

BIG = "<p>" + "é" * 200 + "\r\n\r\nWARC/1.1\r\n</p>"
PAGES = [
    (5, "http://a.example.com/x?q#f", BIG), (3, "http://b.example.com/", BIG), (9, None, BIG), (None, "http://c.org/", BIG),
    (4, "http://c.org/\r\nWARC-Type: evil", "short"), (6, "http://c.org/", "short"), (7, "", None), (8, "no scheme", ""),
    (10, "http://c.org/", "y" * 100), (10, "http://c.org/", "y" * 100), (11, "http://c.org/", "y" * 100), (None, None, "z" * 500), (None, None, "z" * 500),
    (12, "http://long.org/", "w " * 200_000), (13, "http://99.org/", "n" * 99), (14, "http://99.org/", "n" * 99),
]


def brute(rows, min_bytes=100):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [k for k, _, h in rows if h == html and k is not None]
        first = min(same, default=None)
        visit = len(data) >= min_bytes and first is not None and i != first
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if visit else "response", first if visit else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in PAGES], "page_id long, url string, html string, digest string, first int").repartition(3)


def found(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=repr)


def test_round_trip(pages):
    assert found(warc.archive_report(pages)) == brute(PAGES)
    assert warc.archive_report(pages.limit(0)).collect() == []


def test_beyond_every_bound(pages, monkeypatch):
    """Small files, blocks of two lines, a directory in pieces, joins instead of broadcasts."""
    for name, value in {"FILE_BYTES": 1, "BLOCK_LINES": 2, "DIRECTORY_ROWS": 2, "BROADCAST_SHARED": 0, "BROADCAST_RANGES": 0}.items():
        monkeypatch.setattr(warc, name, value)
    assert found(warc.archive_report(pages)) == brute(PAGES)


def test_lookup_and_ranges(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    warc.write_archives(pages, f"{tmp_path}/archives")
    records = warc.read_archives(spark, f"{tmp_path}/archives")
    warc.build_index(records, f"{tmp_path}/index")
    urls = spark.createDataFrame([("http://c.org/",), ("HTTP://LONG.org/#x",), ("http://nowhere.org/",), ("http://c.org/",)], "url string")
    hits = warc.lookup(spark, f"{tmp_path}/index", urls)
    want = [(i, u) for i, u, _ in PAGES if u in ("http://c.org/", "http://long.org/")]
    assert sorted((r.page_id, r.url_key) for r in hits.collect() if r.page_id) == sorted((i, "org,c)/" if "c.org" in u else "org,long)/") for i, u in want if i)
    assert hits.count() == len(want)
    read = {r.page_id: r.payload_bytes for r in warc.read_captures(spark, hits.where("page_id in (6, 10, 12)")).collect()}
    assert read == {6: 5, 10: 100, 12: 400_000}
    raw = b"".join(p.read_bytes() for p in (tmp_path / "archives").glob("part-*"))
    assert raw.count(b"\r\n\r\nWARC/1.1\r\nWARC-Type: ") + raw.startswith(b"WARC/1.1") <= len(PAGES)
