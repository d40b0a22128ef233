"""WARC archives and their merged index."""

import base64
import hashlib
import random
import tempfile
import zlib

import pytest
from pyspark.sql import functions as F

from urbanflow.llm import queries, warc

SCHEMA = "page_id bigint, url string, html string, archive string, part int"
PAGES = [
    (5, "https://www.Example.org:443/a?b=1#c", "<p>one</p>", "x", 1), (9, "http://example.org/a?b=1", "<p>one</p>", "x", 1), (7, "http://example.org/z", "<p>one</p>", "x", 1),
    (1, None, None, "x", 1), (2, "http://example.org", "", "x", 1), (3, "ftp://other.net/é\r\nX-Evil: 1", "WARC/1.1\r\n\r\nbody\r\n\r\n", "x", 1), (None, "http://a.b/", "<p>one</p>", "x", 1),
    (None, "http://a.b/", "null ids", "x", 1), (None, "http://a.b/", "null ids", "x", 1), (11, "http://a.b/", "twice", "x", 1), (11, "http://a.b/", "twice", "x", 1), (4, "http://long.org/", "x" * 3_000_000, "x", 1), (-7, "nonsense", "…", "x", 1),
]


def expected(pages):
    last, out = {}, []
    for page, _, html, *_ in pages:
        raw = (html or "").encode()
        if page is not None:
            last[raw] = max(last.get(raw, page), page)
    for page, _, html, *_ in pages:
        raw = (html or "").encode()
        to = last.get(raw)
        to = None if to == page else to
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def indexed(spark, pages, archive_bytes=warc.ARCHIVE_BYTES, rows_a_task=warc.MERGED_ROWS):
    path = "file://" + tempfile.mkdtemp(prefix="spark-")
    df = spark.createDataFrame(pages, SCHEMA).repartition(3)
    manifest = warc.archive(warc.plan(df, at=F.coalesce("page_id", F.lit(0))), path, archive_bytes)
    return path, manifest, warc.index(manifest, path, rows_a_task)


def test_records_come_back(spark):
    path, manifest, found = indexed(spark, PAGES)
    rows = found.collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == expected(PAGES)
    by = {r.page_id: r for r in rows}
    assert by[9].url_key == by[5].url_key == "org,example)/a?b=1" and by[1].url_key == "-" and by[2].url_key == "org,example)/" and by[9].captured == "1970-01-01T00:00:09Z"
    # A record is read by its offset and length alone; revisits hold no payload.
    for r in rows:
        with open(f"{path[7:]}/{r.archive}", "rb") as f:
            f.seek(r.offset)
            fields, http, payload = warc.parsed(zlib.decompress(f.read(r.length), 31))
        assert fields["warc-type"] == r.record_type and len(payload) == (r.payload_bytes if r.record_type == "response" else 0)
    assert manifest.agg(F.sum("n_records")).first()[0] == len(PAGES)


def test_one_order_over_all_parts(spark):
    """Many small archives and parts: the order, the positions and the numbers within each URL's history are those of one sort."""
    rng = random.Random(4)
    hosts = ["hot.org"] * 5 + ["a.com", "b.com", "c.net"]
    pages = [(i, f"http://{(h := rng.choice(hosts))}/{'' if h == 'hot.org' else rng.randint(0, 5)}", f"{rng.randint(0, 30)}", "", 0) for i in range(600)]
    _, manifest, found = indexed(spark, pages, archive_bytes=5000, rows_a_task=40)
    rows = sorted(found.collect(), key=lambda r: r.position)
    assert manifest.count() > 20 and [r.position for r in rows] == list(range(600))
    keys = [(r.url_key, r.captured, r.archive, r.offset) for r in rows]
    assert keys == sorted(keys)
    seen = {}
    for r in rows:
        seen[r.url_key] = seen.get(r.url_key, 0) + 1
        assert r.capture == seen[r.url_key]
    assert seen["org,hot)/"] > 200
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == expected(pages)


def test_no_pages(spark):
    _, manifest, found = indexed(spark, [])
    assert manifest.count() == 0 and found.count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16, 33])
def test_loser_tree(k):
    rng = random.Random(k)
    lists = [sorted(rng.choices(range(50), k=rng.choice([0, 1, 5, 40]))) for _ in range(k)]
    took = list(warc.LoserTree(lists))
    assert [lists[i][j] for i, j in took] == sorted(x for own in lists for x in own)
    assert all([j for i, j in took if i == leaf] == list(range(len(lists[leaf]))) for leaf in range(k))


def test_damage_is_found():
    good = warc.record(1, "http://a.b/", "b,a)/", "1970-01-01T00:00:00Z", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    assert warc.capture(good)["payload_bytes"] == 7
    with pytest.raises(ValueError, match="damaged"):
        warc.capture(good.replace(b"payload\r\n", b"pay1oad\r\n"))

    class Cut:
        def __init__(self, raw):
            self.raw = [raw]

        def read(self, _):
            return self.raw.pop() if self.raw else b""

    whole = warc.member(good) * 2
    assert [(at, n) for at, n, _ in warc.members(Cut(whole))] == [(0, len(whole) // 2), (len(whole) // 2, len(whole) // 2)]
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.members(Cut(whole[:-9])))


def test_query_on_whole_pages(spark):
    sf = "/root/testdata/sf0.001"
    pages = [(r.page_id, None, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = queries.op13_warc(spark, sf).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(pages)
