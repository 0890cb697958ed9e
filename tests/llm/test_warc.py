import hashlib
import heapq
import random

from hypothesis import given
from hypothesis import strategies as st

from marginalia.llm import warc
from marginalia.sources.shared import opened


@given(st.lists(st.lists(st.integers(0, 20))))
def test_loser_tree_merges(runs):
    runs = [sorted(r) for r in runs]
    got = [x[0] for x in warc.LoserTree(iter([(v, i) for v in run]) for i, run in enumerate(runs))]
    assert got == list(heapq.merge(*runs))


def test_loser_tree_is_stable():
    runs = [[(1, "a"), (2, "a")], [(1, "b")], [(0, "c"), (1, "c")]]
    assert list(warc.LoserTree(map(iter, runs))) == [(0, "c"), (1, "a"), (1, "b"), (1, "c"), (2, "a")]


def pages(frame):
    big, other = "x" * 1000, "ü" * 500
    rows = [
        (1, "http://b.example.org/1?q=2#top", big),
        (2, "https://a.example.com:80/", big),
        (3, "https://a.example.com/", "small"),
        (4, None, "small"),
        (5, "no scheme\r\nX-Evil: 1", None),
        (6, "http://a.example.com/z", other),
        (7, "http://a.example.com/z", other),
        (None, "http://a.example.com/n", big),
        (8, "", ""),
        (7, "http://a.example.com/z", other),
    ]
    return rows, frame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, payload_digest string, archive string")


def test_round_trip(frame):
    rows, df = pages(frame)
    index, records = warc.archive_pages(df)
    got = sorted(records.collect(), key=lambda r: (r.page_id is None, r.page_id or 0))
    assert len(got) == len(rows) == index.count()
    kinds = [(r.page_id, r.record_type, r.refers_to) for r in got]
    assert kinds == [
        (1, "revisit", 2),
        (2, "response", None),
        (3, "response", None),
        (4, "response", None),
        (5, "response", None),
        (6, "revisit", 7),
        (7, "response", None),
        (7, "response", None),
        (8, "response", None),
        (None, "response", None),
    ]
    html = {r[0]: (r[2] or "").encode() for r in rows}
    for r in got:
        assert r.payload_bytes == len(html[r.page_id])
        assert r.payload_digest == hashlib.sha1(html[r.page_id]).hexdigest()
        assert r.payload == (None if r.record_type == "revisit" else bytearray(html[r.page_id]))


def test_index_is_globally_ordered(frame, spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    random.seed(2)
    hot = "http://hot.example.com/"
    rows = [(i, hot if i % 3 == 0 else f"http://h{random.randint(0, 9)}.example.com/{i % 50}", f"body {i}") for i in range(400)]
    index, records = warc.archive_pages(frame(rows, "page_id long, url string, html string", 5))
    listed = [(r.url_key, r.captured, r.page_id) for r in index.collect()]
    ordered = index.select("url_key", "captured", "page_id").orderBy("url_key", "captured", "page_id").collect()
    assert sorted(listed) == [tuple(r) for r in ordered]
    parts = index.rdd.glom().map(lambda p: [(r.url_key, r.captured, r.page_id) for r in p]).collect()
    assert all(p == sorted(p) for p in parts)
    assert index.select("archive").distinct().count() > 5
    assert sorted(r.page_id for r in records.collect()) == list(range(400))


def test_archives_are_whole_gzip_members(frame):
    import zlib

    _, df = pages(frame)
    index, _ = warc.archive_pages(df)
    for archive, in index.select("archive").distinct().collect():
        store, path = opened(archive)
        raw, n = store.open_input_stream(path, compression=None).read(), 0
        while raw:
            unpacker = zlib.decompressobj(31)
            assert unpacker.decompress(raw).startswith(b"WARC/1.1\r\n")
            raw, n = unpacker.unused_data, n + 1
        assert n == index.filter(index.archive == archive).count()


def test_empty(spark):
    index, records = warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"))
    assert index.count() == records.count() == 0


def test_url_key(frame):
    df = frame([("HTTP://WWW.Example.com:8080/A?b=C#d",), (None,), ("http://x",)], "url string")
    assert {r[0] for r in df.select(warc.url_key(df.url)).collect()} == {"com,example,www)/a?b=c", ")", "x)"}
