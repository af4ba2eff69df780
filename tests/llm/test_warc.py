"""Archives and their two-level index: round trips, lookups and the cases that must not break them."""

import gzip
import hashlib
import io

import pytest
from pyarrow.fs import FileSystem
from pyspark.sql import functions as F

from candlewick.llm import warc

SCHEMA = "page_id long, url string, html string, key string, digest string, file string, page string"
LONG = "<p>grüße</p>" * 20
ROWS = [
    (5, "http://Blog.Example.org:80/a/b?q=1#top", LONG), (3, "https://user@example.org/", LONG), (9, "http://example.org", LONG),
    (4, "http://example.org/x", "short"), (2, "http://example.org/x", "short"), (7, None, None), (8, "", ""),
    (None, "http://example.org/n", LONG), (None, "http://example.org/m", "z" * 200),
    (11, "http://a.b/\r\nWARC-Type: odd %41", "y" * 100), (12, "http://a.b/ ü", "y" * 100), (13, "http://a.b/", "y" * 99), (14, "http://a.b/z", "y" * 99),
    (20, "http://same.org/", "s" * 300), (20, "http://same.org/", "s" * 300), (21, "http://same.org/", "t" * 300), (22, "http://else.org/", "s" * 300),
    (30, "http://big.org/", "q" * 3_000_000),
]
ROWS += [(100 + i, f"http://host{i % 7}.org/p{i}", f"{i % 13:0120d}") for i in range(150)]


def plain():
    first = {}
    for page, _, html in ROWS:
        if page is not None and html and len(html.encode()) >= 100:
            first[html] = min(page, first.get(html, page))
    out = []
    for page, _, html in ROWS:
        data = (html or "").encode()
        to = first.get(html)
        revisit = to is not None and page != to
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def held(spark):
    pages = spark.createDataFrame([(*r, "k", "d", "f", "p") for r in ROWS], SCHEMA).repartition(5).cache()
    folder, pointers = warc.write_archives(pages)
    return pages, folder, pointers


@pytest.mark.parametrize("lines, per_file", [(3000, 300_000), (7, 20), (1, 1)])
def test_every_page_comes_back(spark, held, lines, per_file, monkeypatch):
    monkeypatch.setattr(warc, "PER_FILE", per_file)
    pages, folder, pointers = held
    captures = warc.build_index(folder, pointers, lines)
    assert (len(captures.files) > 3) == (per_file < 100)
    told = warc.read_pages(captures, warc.lookups(pages, warc.url_key(F.col("url")), F.col("page_id"))).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in told), key=str) == plain()


@pytest.mark.parametrize("lines, per_file", [(3000, 300_000), (2, 9)])
def test_lookups_by_url_and_host(spark, held, lines, per_file, monkeypatch):
    monkeypatch.setattr(warc, "PER_FILE", per_file)
    _, folder, pointers = held
    captures = warc.build_index(folder, pointers, lines)
    asked = spark.createDataFrame([("HTTP://example.org:80/x#y",), ("http://same.org",), ("http://nowhere.org/",), ("http://aaa/",), ("https://zzz.zz/",)], "url string")
    found = warc.fetch(captures, warc.find(captures, warc.lookups(asked, warc.url_key(F.col("url")))), payload=True).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in found if r.payload is not None) == [(2, "short"), (4, "short"), (20, "s" * 300), (20, "s" * 300), (21, "t" * 300)]
    hosts = spark.createDataFrame([("org,host3)",), ("org,host",)], "k string")
    found = warc.find(captures, warc.lookups(hosts, F.col("k"), prefix=True)).collect()
    assert len(found) == 150 + sum(i % 7 == 3 for i in range(150))


def test_archives_are_gzip_members_in_warc_format(held):
    _, folder, pointers = held
    rows = pointers.orderBy("file", "offset").collect()
    fs, path = FileSystem.from_uri(f"{folder}/{rows[0].file}")
    data = fs.open_input_file(path).read()
    whole = gzip.GzipFile(fileobj=io.BytesIO(data)).read()
    own = [r for r in rows if r.file == rows[0].file]
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and whole.count(b"\r\nWARC-Record-ID: <urn:uuid:") == len(own) + 1
    fields, _ = warc.parse(gzip.decompress(data[own[0].offset : own[0].offset + own[0].length]))
    assert fields["WARC-Type"] in ("response", "revisit") and int(fields["Content-Length"]) > 0


def test_a_damaged_archive_is_noticed(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "x" * 500, *"abcd")], SCHEMA)
    captures = warc.capture(pages)
    row = captures.pointers.collect()[0]
    fs, path = FileSystem.from_uri(f"{captures.folder}/{row.file}")
    data = bytearray(fs.open_input_file(path).read())
    raw = gzip.decompress(bytes(data[row.offset :])).replace(b"xxx", b"xyx", 1)
    with fs.open_output_stream(path) as out:
        out.write(bytes(data[: row.offset]) + (packed := warc._member(raw, 6)))
    moved = captures.pointers.withColumn("length", F.lit(len(packed)).cast("long"))
    with pytest.raises(Exception, match="digest"):
        warc.fetch(captures, moved).collect()


def test_keys(spark):
    urls = {"http://Blog.Example.org:80/a/b?q=1#top": "org,example,blog)/a/b?q=1", "https://u:p@h.de": "de,h)/", "h.de/x": "de,h)/x", "http://h:8080/": "h:8080)/", "": ")/", None: "-", "mailto:a@b": "b)/"}
    got = spark.createDataFrame([(u,) for u in urls], "u string").select("u", warc.url_key(F.col("u")).alias("k")).collect()
    assert {r.u: r.k for r in got} == urls


def test_no_pages(spark):
    pages = spark.createDataFrame([], SCHEMA)
    captures = warc.capture(pages)
    assert captures.files == [] and warc.read_pages(captures, warc.lookups(pages, warc.url_key(F.col("url")), F.col("page_id"))).collect() == []
