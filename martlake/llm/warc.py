"""WARC archives with a capture index made by an external merge.

Writing: pages with equal payloads (by SHA-256) are found by narrow aggregates. Frequent digests, which a Misra-Gries summary
names (at most 1/``SUPPORT`` of them), are settled where rows are read; the others go through an ordinary shuffle.
The row with the smallest id becomes a ``response`` record, the others ``revisit`` records that refer to it and hold only the
HTTP header. A task packs its records, each a gzip member of its own, into archives of about ``ARCHIVE_BYTES`` bytes, and
Spark's text sink writes each archive as one file in the shared folder. It ends each file with its line separator, here
one zero byte, which gzip readers take as padding.

Reading: archives are read back through Spark's binary source and parsed member by member. Each archive yields one run
of captures, sorted by URL key, timestamp, archive and offset. The runs are dealt to key ranges of about ``RANGE_CAPTURES``
captures (archive and offset are part of the order, so one URL with a third of the captures is split too), and in each range a
loser tree merges the k runs. The result is ordered by (range, rank): the capture history of each URL, over all archives.

Defined cases: a null payload is the empty payload; all rows with the smallest id of a payload are responses (repeated rows
too), a null id is larger than any other, and a group without ids has only responses; a null URL gives a record without a target and
the empty key; control characters and blanks of a URL are percent-escaped in the archive; a page without a capture time gets
``CRAWL_START`` plus its id in seconds (modulo a year); an empty table gives no rows and no archives.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm.columns import scratch_table
from martlake.session import scratch_path

SUPPORT = 0.001
#: Compressed bytes of an archive, about; one larger record has its own.
ARCHIVE_BYTES = 32 << 20
#: Captures that one task merges, about.
RANGE_CAPTURES = 100_000
CRAWL_START = datetime.datetime(2024, 1, 1)
YEAR_SECONDS = 365 * 86_400
_FEED = 16 << 10
_ID_URN = "urn:martlake:page:"
_CAPTURE = ("page_id string, url string, url_key string, capture_time string, record_type string, payload_bytes long, "
            "payload_digest string, refers_to string, intact boolean, archive string, offset long, length long")


def url_key(url: str | None) -> str:
    """Sort-friendly key of a URL: host labels reversed, then path and sorted query; without scheme, leading ``www.``,
    default port and fragment; all in lower case. What is no URL is its own key."""
    if not url:
        return ""
    try:
        u = urlsplit(url.strip().lower())
        host, port = u.hostname or "", u.port
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    labels = ",".join(reversed(host.removeprefix("www.").split(".")))
    place = f":{port}" if port and port != {"http": 80, "https": 443}.get(u.scheme) else ""
    query = f"?{'&'.join(sorted(u.query.split('&')))}" if u.query else ""
    return f"{labels}{place}){u.path or '/'}{query}"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: str | None) -> str:
    return f"<{_ID_URN}{quote(page_id or '', safe='')}>"


def record(page_id: str | None, url: str | None, time: str, payload: bytes, first: str | None, revisit: bool) -> bytes:
    """One WARC record; a revisit has the HTTP header only, with the length of the whole payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", time)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _urn(first))]
    fields += [("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"), ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
               ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member; zero bytes between and after them are padding."""
    view, at = memoryview(data), 0
    while at < len(data):
        if not view[at]:
            at += 1
            continue
        d, parts, end = zlib.decompressobj(31), [], at
        while not d.eof:
            if end >= len(data):
                raise ValueError(f"the member at {at} is cut off")
            step = view[end:end + _FEED]
            parts.append(d.decompress(step))
            end += len(step)
        end -= len(d.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


def parse(content: bytes) -> dict:
    """Fields of a record, with its payload, the length of the whole payload, and whether its digests hold."""
    head, _, rest = content.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError(f"no WARC record: {version[:20]!r}")
    f = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(f["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = f["WARC-Type"] == "revisit"
    whole = int(re.search(rb"Content-Length: (\d+)", http)[1])
    stated = f["WARC-Payload-Digest"].removeprefix("sha1:")
    intact = f["WARC-Block-Digest"] == f"sha1:{payload_digest(block)}" and (revisit or (len(payload) == whole and payload_digest(payload) == stated))
    return f | {"payload": payload, "payload_bytes": whole, "payload_digest": stated, "intact": intact}


def with_origin(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url",
                time_col: str | None = None, support: float = SUPPORT) -> DataFrame:
    """page_id, url, time, payload, first and revisit: the smallest id with an equal payload, and whether the row refers to it."""
    no_time = F.timestamp_seconds(F.lit(int(CRAWL_START.replace(tzinfo=datetime.timezone.utc).timestamp())) + F.coalesce(
        F.pmod(F.col(id_col).try_cast("bigint"), F.lit(YEAR_SECONDS)), F.lit(0)))
    time = F.coalesce(F.col(time_col).cast("timestamp"), no_time) if time_col else no_time
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("sha"))
    ids = scratch_table(rows.select("sha", "page_id"), "warc-digests")
    groups = (ids.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").drop("n"))
    frequent = F.broadcast(ids.freqItems(["sha"], support).select(F.explode("sha_freqItems").alias("sha")))
    head = F.broadcast(groups.join(frequent, "sha", "left_semi"))
    known = rows.join(F.broadcast(frequent), "sha", "left_semi").join(head, "sha", "left")
    others = rows.join(frequent, "sha", "left_anti").join(groups.join(frequent, "sha", "left_anti"), "sha", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return known.unionByName(others).select("page_id", "url", "time", "payload", "first", revisit.alias("revisit"))


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, **cols) -> str:
    """Write the pages as WARC files (one gzip member per record) into the folder ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for page in zip(*(b.column(c) for c in ("page_id", "url", "time", "payload", "first", "revisit")), strict=True):
                held.append(_member(record(*(x.as_py() for x in page))))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])

    rows = with_origin(pages, **cols)
    rows = rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "time", "payload",
                       F.col("first").cast("string").alias("first"), "revisit")
    (rows.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
     .write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path))
    return path


def read_captures(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Captures of the archives in ``path`` (their payloads too if wanted). Those of one archive
    come together and in order: a run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("path"), b.column("content"), strict=True):
                yield from _run_of(name.as_py(), content.as_py(), payload)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, _CAPTURE + (", payload binary" if payload else ""))


def _run_of(archive: str, content: bytes, payload: bool, size: int = 1000) -> Iterator[pa.RecordBatch]:
    schema = _capture_schema(payload)
    rows = []
    for offset, length, data in members(content):
        r = parse(data)
        url, first = r.get("WARC-Target-URI"), r.get("WARC-Refers-To")
        rows.append({"page_id": _id_of(r["WARC-Record-ID"]), "url": url, "url_key": url_key(url),
                     "capture_time": re.sub(r"\D", "", r["WARC-Date"]), "record_type": r["WARC-Type"],
                     "payload_bytes": r["payload_bytes"], "payload_digest": r["payload_digest"],
                     "refers_to": first and _id_of(first), "intact": r["intact"], "archive": archive, "offset": offset,
                     "length": length} | ({"payload": r["payload"]} if payload else {}))
    rows.sort(key=_order)
    for lo in range(0, len(rows), size):
        yield pa.RecordBatch.from_pylist(rows[lo:lo + size], schema)


def _capture_schema(payload: bool) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [x.split() for x in (_CAPTURE + (", payload binary" if payload else "")).split(", ")]
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


def _id_of(urn: str) -> str | None:
    return unquote(urn.strip("<>").removeprefix(_ID_URN)) or None


_KEY = ("url_key", "capture_time", "archive", "offset")


def _order(r: dict) -> tuple:
    return tuple(r[k] for k in _KEY)


class LoserTree:
    """Merges k ascending iterators: the winner is at the root, each inner node keeps the loser of its match,
    so an item costs one match per level on the way up from its leaf."""

    def __init__(self, runs: list[Iterator]):
        self.runs, self.k = runs, max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.losers = [0] * self.k
        winner = [0] * (2 * self.k)
        for i in range(self.k):
            winner[self.k + i] = i
        for node in range(self.k - 1, 0, -1):
            a, b = winner[2 * node], winner[2 * node + 1]
            winner[node], self.losers[node] = (a, b) if self._first(a, b) else (b, a)
        self.top = winner[1] if self.k > 1 else 0

    def _first(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None
        return x < y or (x == y and a < b)

    def __iter__(self):
        heads, losers = self.heads, self.losers
        while (item := heads[self.top]) is not None:
            yield item
            i = self.top
            heads[i] = next(self.runs[i], None)
            node = (self.k + i) >> 1
            while node:
                if self._first(losers[node], i):
                    losers[node], i = i, losers[node]
                node >>= 1
            self.top = i


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One key range: its rows are cut into runs (ascending stretches), which a loser tree merges."""
    held = [b for b in batches if len(b)]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    keys = list(zip(*(rows.column(c).to_pylist() for c in _KEY), range(len(rows)), strict=True))
    cuts = [0, *(i for i in range(1, len(keys)) if keys[i][:-1] < keys[i - 1][:-1]), len(keys)]
    tree = LoserTree([iter(keys[a:z]) for a, z in zip(cuts, cuts[1:])])
    order = pa.array([k[-1] for k in tree], pa.int64())
    part = pa.array([TaskContext.get().partitionId()] * len(rows), pa.int32())
    merged = rows.take(order).append_column("range", part).append_column("rank", pa.array(range(len(rows)), pa.int64()))
    yield from merged.combine_chunks().to_batches(10_000)


def capture_index(runs: DataFrame, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """The captures of all runs in global order: by (range, rank), that is by URL key, timestamp, archive and offset.

    ``runs`` should be a written table, since its rows are counted and sampled for the ranges before they are merged."""
    n = -(-runs.count() // range_captures) or 1
    return runs.repartitionByRange(n, *_KEY).mapInArrow(_merge, _CAPTURE + ", range int, rank long")


def write_index(index: DataFrame, path: str) -> None:
    """Write the merged index as sorted lines ``key time {json}``, one file per range."""
    line = F.concat_ws(" ", "url_key", "capture_time", F.to_json(F.struct(
        "url", F.col("payload_digest").alias("digest"), F.col("record_type").alias("type"), "length", "offset",
        F.col("archive").alias("filename"))))
    index.sortWithinPartitions("range", "rank").select(line.alias("value")).write.text(path)


def archive_report(pages: DataFrame, id_col: str = "page_id", **cols) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from its archives
    through the merged index."""
    spark = pages.sparkSession
    path = write_archives(pages, scratch_path(spark, f"warc-{uuid.uuid4().hex}"), id_col=id_col, **cols)
    index = capture_index(scratch_table(read_captures(spark, path), "warc-runs"))
    kind = pages.schema[id_col].dataType
    intact = F.when(F.col("intact"), F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("damaged record in "), "archive")))
    return index.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", intact.alias("payload_digest"),
                        "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
