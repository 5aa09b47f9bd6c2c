"""WARC archives against a plain rebuild of the contract, their files against a reader of their own, and the merge against a sort."""

import base64
import gzip
import hashlib
import io
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlake.llm import warc as W

LONG = "".join(random.Random(3).choices("abcdefgh \r\n<>é", k=400_000))
PAGES = [(1, "http://a.example.com/x?b=2&a=1#top", "<html>one</html>"), (2, "https://www.a.example.com:443/x?a=1&b=2", "<html>one</html>"),
         (3, None, None), (4, "", ""), (5, "not a url", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"), (6, "http://b.org/é\r\nX: 1 2", LONG),
         (7, "http://b.org/p", "漢字 🙂"), (8, "HTTP://B.org:8080/P", LONG), (9, "http://[bad", "x"), (9, "http://[bad", "x"), (0, "http://z.net", "x"),
         (None, "http://c.org/n", "<html>one</html>"), (None, "http://c.org/n", "only without id"), (None, "http://c.org/n", "only without id")]
HOT = [(100 + i, f"http://hot.example.com/{i % 3}", "<p>same page</p>") for i in range(300)]


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("first", "revisit", "payload", "time", "sha", "range", "rank", "archive"):
        df = df.withColumn(c, F.lit("x"))
    return df.repartition(3)


def brute(rows):
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h or ""] = min(least.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw, first = (h or "").encode(), least.get(h or "")
        new = first is None or first == i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if new else "revisit", None if new else first))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    assert got(W.archive_report(pages(spark, PAGES + HOT))) == brute(PAGES + HOT)


def test_without_frequent_digests_and_with_small_archives(spark, tmp_path):
    rows = PAGES + HOT
    W.write_archives(pages(spark, rows), str(tmp_path / "w"), archive_bytes=4096, support=0.9)
    captures = W.read_captures(spark, str(tmp_path / "w"), payload=True)
    assert captures.select("archive").distinct().count() > 5
    assert captures.filter("not intact").isEmpty()
    kept = {(r.page_id, bytes(r.payload).decode()) for r in captures.filter("record_type = 'response'").collect()}
    want = {(None if i is None else str(i), h or "") for i, _, h in rows}
    assert kept == {(None if b[0] is None else str(b[0]), h) for b in brute(rows) if b[3] == "response" for i, h in want if i == (None if b[0] is None else str(b[0]))
                    and base64.b32encode(hashlib.sha1(h.encode()).digest()).decode() == b[2]}


def test_files_are_gzip_members_found_by_offset(spark, tmp_path):
    W.write_archives(pages(spark, PAGES), str(tmp_path / "w"))
    for r in W.read_captures(spark, str(tmp_path / "w")).collect():
        with open(r.archive.removeprefix("file:"), "rb") as f:
            f.seek(r.offset)
            text = gzip.GzipFile(fileobj=io.BytesIO(f.read(r.length))).read()
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and text.endswith(b"\r\n\r\n")
    whole = b"".join(gzip.open(tmp_path / "w" / n).read() for n in os.listdir(tmp_path / "w") if n.startswith("part-"))
    assert whole.count(b"WARC-Record-ID: <urn:martlake:page:") == len(PAGES)  # padding does not stop a plain reader


def test_index_is_in_global_order(spark, tmp_path):
    rows = PAGES + HOT + [(1000 + i, f"http://site{i % 50}.example.com/{i % 7}", f"page {i}") for i in range(900)]
    W.write_archives(pages(spark, rows).repartition(6), str(tmp_path / "w"), archive_bytes=3000)
    runs = W.scratch_table(W.read_captures(spark, str(tmp_path / "w")), "test-runs")
    index = W.capture_index(runs, range_captures=100)
    found = index.orderBy("range", "rank").collect()
    key = [(r.url_key, r.capture_time, r.archive, r.offset) for r in found]
    assert len(found) == len(rows) and key == sorted(key)
    ranges = [r["count"] for r in index.groupBy("range").count().collect()]
    assert len(ranges) > 5 and max(ranges) < len(rows) / 3  # one URL's captures are split
    W.write_index(index, str(tmp_path / "cdx"))
    files = sorted((tmp_path / "cdx").glob("part-*"))
    lines = [x for f in files for x in f.read_text().splitlines()]
    assert [x.split(" ")[0] for x in lines] == [k[0] for k in key]


def test_damaged_archives_are_found():
    data = W._member(W.record("1", "http://a.org", "2024-01-01T00:00:00Z", b"payload", None, False))
    with pytest.raises(ValueError):
        list(W.members(data[:-9]))
    good = W.parse(next(W.members(data + b"\0"))[2])
    assert good["intact"] and good["payload"] == b"payload"
    bad = W.record("1", "http://a.org", "2024-01-01T00:00:00Z", b"payload", None, False).replace(b"payload\r\n", b"payl0ad\r\n")
    assert not W.parse(bad)["intact"]


def test_empty_table(spark):
    assert W.archive_report(pages(spark, [])).collect() == []


def test_url_keys():
    assert W.url_key("HTTP://www.Example.com:80/A?z=1&b=2#f") == "com,example)/a?b=2&z=1"
    assert W.url_key("https://example.com:8443") == "com,example:8443)/"
    assert W.url_key(None) == W.url_key("") == ""
    assert W.url_key("mailto:x") == "mailto:x"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30)), max_size=9))
def test_loser_tree(runs):
    runs = [sorted(r) for r in runs]
    assert list(W.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)
