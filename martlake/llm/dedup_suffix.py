"""Removal of byte strings that occur earlier, by longest-previous-factor arrays over a distributed suffix array.

A byte goes if some ``LENGTH``-byte string over it also starts earlier (smaller doc_id, or earlier in the same
document); strings are judged on the input. In suffix order the previous and the next smaller position of a
suffix are its best earlier matches, so the longest previous factor is the longer common prefix with either;
where it reaches LENGTH the string starts earlier, and only the first copy of anything stays.

One suffix array of all text cannot be sorted at scale, and most suffixes match nothing. So suffixes are
dealt by content: the smallest hash of the K-byte strings inside a LENGTH-byte window is the same for
equal windows, wherever they stand, and neighbouring windows mostly share it and travel as one run.

1. Every document sends (smallest hash, document, run number) of its runs, packed in arrays, to the hash's bucket.
   A hash that occurs once has no equal in another run; only runs of repeated hashes go on, and runs in which the string
   of the smallest hash stands more than once, as in periodic text: their windows may equal each other.
2. Those runs are cut from the text and dealt to buckets by their hash. In a bucket equal runs are settled as wholes,
   the others by a suffix array (prefix doubling to LENGTH bytes) with its previous-factor array.
3. A hash of more than ``HOT`` runs (a passage in a third of all documents) would fill its bucket. The most frequent hashes are known
   beforehand, from the runs of one document in ``SAMPLE`` (at most ``VERY_HOT`` hashes; which ones decides on the way taken, not
   on the result), and their runs are never gathered by hash: they go to step 2 marked as hot. The
   windows of hot runs go singly, named by 128-bit hashes, to the buckets of their names; each task first settles what it
   can itself and sends a name once. The order of the names takes the place of suffix order there, the rest is the same.

The number of buckets follows the bytes of the input, so a bucket stays a few MB. Text is shuffled once.

Defined cases: null text is empty (kept_sha256 of no bytes); a text shorter than LENGTH loses nothing; a null doc_id
comes after all others (those without one are ordered by a hash of the text); rows with one doc_id and one text are one document and each gets its result; different texts
with one doc_id are ordered by a hash of the text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.columns import mix64, prefix_hash, range_hash, slices, text_bytes, with_fields

LENGTH = 100
K = 32
#: Windows of a run, at most (only periodic text has longer ones).
RUN = 256
#: Runs with one hash that may meet in a bucket.
HOT = 4_096
#: Bytes of input for each bucket, and bytes that a task packs before it sends them.
BUCKET_BYTES = 8 << 20
PACK_BYTES = 8 << 20
#: One document in so many is looked at for very frequent hashes; runs there that make a hash one, and how many there are at most.
SAMPLE = 64
SAMPLE_RUNS = 512
VERY_HOT = 1_000_000
#: Null ids come after all others, spread over so many keys by the hash of the text.
_LAST, _NULL_KEYS = (1 << 63) - 1, 1 << 40


# -- kernels --------------------------------------------------------------------------------------------

def runs_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(smallest hash, first window, windows, text) of each run of windows that share their smallest hash."""
    n, w = len(data), LENGTH - K + 1
    size = np.diff(offsets) - LENGTH + 1  # windows of each text
    if n < LENGTH or not (size > 0).any():
        z = np.empty(0, np.int64)
        return np.empty(0, np.uint64), z, z, z
    at = np.arange(n - K + 1)
    m = range_hash(prefix_hash(data), at, at + K)
    step = 1
    while 2 * step <= w:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    if step < w:
        m = np.minimum(m[:len(m) - (w - step)], m[w - step:])
    have = np.flatnonzero(size > 0)
    first = offsets[:-1][have]
    inside = np.zeros(len(m) + 1, np.int32)
    np.add.at(inside, first, 1)
    np.add.at(inside, first + size[have], -1)
    own = np.cumsum(inside[:-1]) > 0
    starts = own.copy()
    starts[1:] &= (m[1:] != m[:-1]) | ~own[:-1]
    starts[first] = True
    begin = np.flatnonzero(starts)
    text = np.searchsorted(offsets, begin, side="right") - 1
    stop = np.minimum(np.append(begin[1:], n), (offsets[1:] - LENGTH + 1)[text])
    parts = -(-(stop - begin) // RUN)
    if (parts > 1).any():
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        stop, text = np.repeat(stop, parts), np.repeat(text, parts)
        begin = np.repeat(begin, parts) + nth * RUN
        stop = np.minimum(stop, begin + RUN)
    return m[begin], begin, stop - begin, text


def repeats_inside(data: np.ndarray, h: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Whether windows of one run may be equal: then the K-byte string of the smallest hash stands in it more than once."""
    out = np.zeros(len(h), bool)
    several = np.flatnonzero(count > 1)
    if not len(several):
        return out
    every = np.arange(len(data) - K + 1)
    g = range_hash(prefix_hash(data), every, every + K)
    for lo in range(0, len(several), 1 << 14):
        own = several[lo:lo + (1 << 14)]
        n = count[own] + LENGTH - K
        first = np.cumsum(n) - n
        same = g[np.arange(n.sum()) + np.repeat(begin[own] - first, n)] == np.repeat(h[own], n)
        out[own] = np.add.reduceat(same, first, dtype=np.int64) > 1
    return out


def truncated_suffix_array(data: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the windows of runs, by their first LENGTH bytes, and the rank of each window.

    ``data`` holds the runs one after another (run r: counts[r] windows, counts[r] + LENGTH - 1 bytes from
    starts[r] on). Prefix doubling: 8-byte ranks first, then 16, 32, 64 and LENGTH.
    """
    def places(reach: int) -> np.ndarray:  # positions whose ``reach`` bytes lie inside their run
        n = counts + LENGTH - reach
        return np.repeat(starts, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)

    at = places(8)
    key = np.zeros(len(at), np.uint64)
    for j in range(8):
        key = (key << np.uint64(8)) | data[at + j].astype(np.uint64)
    rank = np.zeros(len(data), np.uint64)
    _, name = np.unique(key, return_inverse=True)
    rank[at] = name
    reach = 8
    while reach < LENGTH:
        ahead = min(reach, LENGTH - reach)
        at = places(reach + ahead)
        key = (rank[at] << np.uint64(32)) | rank[at + ahead]
        _, name = np.unique(key, return_inverse=True)
        rank[at] = name
        reach += ahead
    order = np.argsort(name, kind="stable")
    return order, name


def earlier_match(order: np.ndarray, rank: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Whether each window's longest previous factor reaches LENGTH.

    ``order`` is a suffix order, equal ``rank`` means a common prefix of LENGTH, ``position`` orders the windows
    in the corpus (equal positions are one window read twice). The previous smaller position in suffix order is
    found by following links backwards, the next smaller by the same on the reversed order; a link leaves
    the range of equal prefixes at most once, and there the factor is shorter than LENGTH.
    """
    out = np.zeros(len(order), bool)
    for suffixes in (order, order[::-1]):
        pos, cls = position[suffixes], rank[suffixes]
        link = np.arange(len(suffixes)) - 1
        open_ = np.flatnonzero(link >= 0)
        while len(open_):
            here = open_[cls[link[open_]] == cls[open_]]  # others: no common prefix of LENGTH further on
            found = pos[link[here]] < pos[here]
            out[suffixes[here[found]]] = True
            here = here[~found]
            link[here] = link[link[here]]
            open_ = here[link[here] >= 0]
    return out


def window_names(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit names of the LENGTH-byte windows from each position on."""
    a = np.full(len(at), 0x243F6A8885A308D3, np.uint64)
    b = np.full(len(at), 0x13198A2E03707344, np.uint64)
    for off in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        word = np.zeros(len(at), np.uint64)
        for j in range(8):
            word = (word << np.uint64(8)) | data[at + (off + j)].astype(np.uint64)
        a = mix64(a ^ word)
        b = mix64((b + word) * np.uint64(0x9FB21C651E98DF25))
    return a, b


def _order(doc: np.ndarray, text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Places of (document, text hash, start) in the corpus; equal triples get one place."""
    o = np.lexsort((start, text, doc))
    new = np.ones(len(o), bool)
    new[1:] = (doc[o][1:] != doc[o][:-1]) | (text[o][1:] != text[o][:-1]) | (start[o][1:] != start[o][:-1])
    out = np.empty(len(o), np.int64)
    out[o] = np.cumsum(new)
    return out


def _stretches(hit: np.ndarray, doc: np.ndarray, text: np.ndarray, start: np.ndarray) -> tuple:
    """Windows as (doc, text hash, first window, windows), neighbours together."""
    doc, text, start = doc[hit], text[hit], start[hit]
    o = np.lexsort((start, text, doc))
    doc, text, start = doc[o], text[o], start[o]
    new = np.ones(len(o), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (start[1:] > start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(o)) - 1
    return doc[first], text[first], start[first], start[last] - start[first] + 1 if len(o) else start


def settle_runs(hash_: np.ndarray, doc: np.ndarray, text: np.ndarray, start: np.ndarray, count: np.ndarray,
                data: bytes) -> list[tuple]:
    """Windows with an earlier equal among the runs of one bucket, as stretches."""
    place = _order(doc, text, start)
    first = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
    best: dict[bytes, int] = {}
    same = np.empty(len(hash_), np.int64)
    bodies = [data[a:a + n] for a, n in zip(first.tolist(), (count + LENGTH - 1).tolist(), strict=True)]
    rank = place.tolist()
    for i, body in enumerate(bodies):  # the earliest of equal runs
        j = best.setdefault(body, i)
        if rank[i] < rank[j]:
            best[body] = i
    for i, body in enumerate(bodies):
        same[i] = best[body]
    later = place > place[same]
    out = [(doc[later], text[later], start[later], count[later])]
    one = np.array(sorted(best.values()), np.int64)
    # Distinct runs: those alone with their hash match nothing, unless they repeat inside themselves.
    _, group, size = np.unique(hash_[one], return_inverse=True, return_counts=True)
    left = [i for i, s in zip(one.tolist(), size[group].tolist(), strict=True) if s > 1 or count[i] > 1 and _periodic(bodies[i])]
    if left:
        left = np.array(left)
        n = count[left]
        body = np.frombuffer(b"".join([bodies[i] for i in left]), np.uint8)
        begin = np.cumsum(n + LENGTH - 1) - (n + LENGTH - 1)
        order, name = truncated_suffix_array(body, begin, n)
        at = np.repeat(start[left], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        d, t = np.repeat(doc[left], n), np.repeat(text[left], n)
        out.append(_stretches(earlier_match(order, name, _order(d, t, at)), d, t, at))
    return out


def _periodic(body: bytes) -> bool:
    """Whether some window may occur twice in the run: then the bytes that all its windows share do so too."""
    n = len(body) - LENGTH  # the last window's start
    return n >= LENGTH - 8 or body.find(body[n:LENGTH], body.find(body[n:LENGTH]) + 1) >= 0


def settle_names(a: np.ndarray, b: np.ndarray, doc: np.ndarray, text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each named window has an earlier equal among them."""
    order = np.lexsort((b, a))
    new = np.ones(len(order), np.int64)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    name = np.empty(len(order), np.int64)
    name[order] = np.cumsum(new)
    return earlier_match(order, name, _order(doc, text, start))


# -- jobs -----------------------------------------------------------------------------------------------

def _packed(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, list[bytes]]]:
    """The rows of each bucket, every column as bytes, in the order that they came."""
    order = np.argsort(bucket, kind="stable")
    own, cut = np.unique(bucket[order], return_index=True)
    columns = [c[order] for c in columns]
    for k, lo, hi in zip(own.tolist(), cut.tolist(), np.append(cut, len(order))[1:].tolist(), strict=True):
        yield k, [c[lo:hi].tobytes() for c in columns]


def _unpacked(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _bucket(hash_: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(hash_ + np.uint64(0x632BE59BD9B4E019)) % np.uint64(buckets)).astype(np.int64)


def _count_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """hash, n of the runs of each slice of text."""
    for b in batches:
        for lo, hi in slices(b.column("text")):
            h, n = np.unique(runs_of(*text_bytes(b.column("text").slice(lo, hi - lo)))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], ["hash", "n"])


def very_hot(base: DataFrame) -> np.ndarray:
    """The most frequent hashes of runs, ascending, judged by a sample of the documents."""
    some = base.filter(F.pmod("hashed", F.lit(SAMPLE)) == 0).select("text")
    counts = some.mapInArrow(_count_hashes, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= SAMPLE_RUNS)
    top = counts.orderBy(F.desc("n"), "hash").limit(VERY_HOT).select("hash").collect()
    return np.sort(np.array([r["hash"] for r in top], np.int64).view(np.uint64))


def _send_hashes(buckets: int, hot=None):
    """Runs packed by the bucket of their hash (kind 0); those of the hashes ``hot`` by document (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        known = hot.value if hot is not None else np.empty(0, np.uint64)

        def flush():
            h, doc, number = (np.concatenate(c) for c in zip(*held, strict=True))
            often = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h if len(known) else np.zeros(len(h), bool)
            rows = []
            for kind, own in ((0, ~often), (1, often)):
                where = _bucket(h[own], buckets) if kind == 0 else doc[own] % buckets
                rows += [(k, kind, *cols) for k, cols in _packed(where, [h[own], doc[own], number[own]])] if own.any() else []
            kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 3
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                             ["bucket", "kind", "hashes", "docs", "numbers"])

        for b in batches:
            for lo, hi in slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                data, off = text_bytes(part.column("text"))
                h, begin, count, text = runs_of(data, off)
                number = np.arange(len(h)) - np.searchsorted(text, text)
                number = np.where(repeats_inside(data, h, begin, count), -1 - number, number)
                held.append((h, part.column("key").to_numpy()[text], number.astype("<i4")))
                if sum(len(x[0]) for x in held) * 20 > PACK_BYTES:
                    yield from flush()
                    held = []
        if held:
            yield from flush()
    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Runs whose hash occurs more than once, or that came as -1 - n as they may repeat inside themselves: key, number
    (negative -1 - n if the hash is hot). Runs that came as hot are passed on as such."""
    kind = table["kind"].to_numpy()
    table, often = table.filter(pa.array(kind == 0)), table.filter(pa.array(kind == 1))
    h, doc, number = _unpacked(table["hashes"], "<u8"), _unpacked(table["docs"], "<i8"), _unpacked(table["numbers"], "<i4")
    order = np.argsort(h, kind="stable")
    h = h[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.empty(0, np.int64)
    size = np.diff(np.append(first, len(h)))
    size = np.repeat(size, size)
    on = (size > 1) | (number[order] < 0)
    own = order[on]
    n = number[own].astype(np.int64)
    n = np.where(n < 0, -1 - n, n)
    n = np.where(size[on] > HOT, -1 - n, n)
    sure = _unpacked(often["numbers"], "<i4").astype(np.int64)
    return pa.table({"key": np.concatenate([doc[own], _unpacked(often["docs"], "<i8")]),
                     "number": np.concatenate([n, np.where(sure < 0, sure, -1 - sure)])})


def _cut_runs(buckets: int):
    names = ["bucket", "kind", "hashes", "docs", "texts", "starts", "counts", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 6
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        def cold():
            h, doc, text, start, count = (np.concatenate(c) for c in list(zip(*held, strict=True))[:5])
            bodies = [x for part in held for x in part[5]]
            where = _bucket(h, buckets)
            order = np.argsort(where, kind="stable")
            cut = np.unique(where[order], return_index=True)[1].tolist()
            rows = list(_packed(where, [h, doc, text, start, count]))
            own = order.tolist()
            return batch([(k, 0, *cols, b"".join([bodies[i] for i in own[lo:hi]]))
                          for (k, cols), lo, hi in zip(rows, cut, [*cut[1:], len(own)], strict=True)])

        for b in batches:
            for lo, hi in slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                lists = part.column("numbers").to_pylist()
                if not any(lists):
                    continue
                data, off = text_bytes(part.column("text"))
                h, begin, count, text = runs_of(data, off)
                base = np.searchsorted(text, np.arange(len(part) + 1))
                pick, hot = [], []
                for d, numbers in enumerate(lists):
                    for n in numbers or ():
                        i = int(base[d]) + (n if n >= 0 else -1 - n)
                        if i < base[d + 1]:  # another text with this doc_id may have more runs
                            (pick if n >= 0 else hot).append(i)
                key, hashed = part.column("key").to_numpy(), part.column("hashed").to_numpy()
                if pick:
                    i = np.unique(np.array(pick))
                    ends = (begin[i] + count[i] + LENGTH - 1).tolist()
                    raw = data.tobytes()
                    bodies = [raw[a:z] for a, z in zip(begin[i].tolist(), ends, strict=True)]
                    held.append((h[i], key[text[i]], hashed[text[i]], (begin[i] - off[text[i]]).astype("<i4"), count[i].astype("<i4"), bodies))
                    size += sum(map(len, bodies))
                    if size > PACK_BYTES:
                        yield cold()
                        held, size = [], 0
                if hot:
                    i = np.unique(np.array(hot))
                    n = count[i]
                    at = np.repeat(begin[i], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    t = np.repeat(text[i], n)
                    a, c = window_names(data, at)
                    doc, hs, start = key[t], hashed[t], at - off[t]
                    later = settle_names(a, c, doc, hs, start)  # the others are the first of their name here
                    done = _stretches(later, doc, hs, start)
                    rows = [(int(doc[0]) % buckets, 2, b"", *[x.astype(k).tobytes() for x, k in zip(done, ("<i8", "<i8", "<i4", "<i4"), strict=True)], b"")]
                    new = ~later
                    rows += [(k, 1, x[0], x[1], x[2], x[3], b"", x[4]) for k, x in _packed(
                        _bucket(a[new], buckets), [a[new], doc[new], hs[new], start[new].astype("<i4"), c[new]])]
                    yield batch(rows)
        if held:
            yield cold()
    return run


def _settle(table: pa.Table) -> pa.Table:
    """Stretches of windows that have an earlier equal: key, hashed, start, windows."""
    out = []
    kind = table["kind"].to_numpy()
    for k in np.unique(kind).tolist():
        t = table.filter(pa.array(kind == k))
        doc, text, start = _unpacked(t["docs"], "<i8"), _unpacked(t["texts"], "<i8"), _unpacked(t["starts"], "<i4").astype(np.int64)
        if k == 0:
            out += settle_runs(_unpacked(t["hashes"], "<u8"), doc, text, start, _unpacked(t["counts"], "<i4").astype(np.int64),
                               b"".join(t["data"].to_pylist()))
        elif k == 1:
            hit = settle_names(_unpacked(t["hashes"], "<u8"), _unpacked(t["data"], "<u8"), doc, text, start)
            out.append(_stretches(hit, doc, text, start))
        else:
            out.append((doc, text, start, _unpacked(t["counts"], "<i4")))
    doc, text, start, count = (np.concatenate(c) for c in zip(*out, strict=True))
    return pa.table({"key": doc.astype(np.int64), "hashed": text.astype(np.int64), "start": start.astype(np.int32), "windows": count.astype(np.int32)})


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi in slices(b.column("text")):
            part = b.slice(lo, hi - lo)
            data, off = text_bytes(part.column("text"))
            own = part.column("hashed").to_pylist()
            removed, spans, digest, kept = [], [], [], []
            for d, found in enumerate(part.column("found").to_pylist()):
                raw = data[off[d]:off[d + 1]]
                found = [x for x in found or () if x["hashed"] == own[d]]
                n = s = 0
                if found:
                    depth = np.zeros(len(raw) + 1, np.int32)
                    for x in found:
                        depth[x["start"]] += 1
                        depth[x["start"] + x["windows"] + LENGTH - 1] -= 1
                    gone = np.cumsum(depth[:-1]) > 0
                    n = int(gone.sum())
                    s = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    raw = raw[~gone]
                removed.append(n)
                spans.append(s)
                kept.append(raw.tobytes())
                digest.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(off), pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes) of every document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    hashed = F.xxhash64(text)
    late = F.lit(_LAST - _NULL_KEYS + 1) + F.shiftright(hashed, 24) + F.lit(_NULL_KEYS // 2)
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), late).alias("key"),
                       text.alias("text"), hashed.alias("hashed"))
    total = docs.select(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    buckets = max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // bucket_bytes))
    hot = docs.sparkSession.sparkContext.broadcast(very_hot(base))
    sent = base.select("key", "text").mapInArrow(
        _send_hashes(buckets, hot), "bucket long, kind int, hashes binary, docs binary, numbers binary")
    repeated = (sent.groupBy("bucket").applyInArrow(_repeated, "key long, number long")
                .groupBy("key").agg(F.collect_list("number").alias("numbers")))
    # Left joins with all columns of the text side in both places, so that its one shuffle serves both.
    runs = (base.join(repeated.hint("shuffle_hash"), "key", "left")
            .mapInArrow(_cut_runs(buckets), "bucket long, kind int, hashes binary, docs binary, texts binary, "
                                            "starts binary, counts binary, data binary"))
    found = runs.groupBy("bucket").applyInArrow(_settle, "key long, hashed long, start int, windows int")
    per_doc = found.groupBy("key").agg(F.collect_list(F.struct("hashed", "start", "windows")).alias("found"))
    last = base.join(per_doc.hint("shuffle_hash"), "key", "left")
    return last.mapInArrow(_remove, with_fields(
        last, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))


def repeat_report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    return remove_repeats(docs, **how).drop("kept")
