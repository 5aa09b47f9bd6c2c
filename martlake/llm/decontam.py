"""Benchmark decontamination: a broadcast set of n-gram windows, scanned over all training text.

Words are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters. A window is ``n``
consecutive words of a benchmark item; an item of fewer words, but not none, is one window.
The benchmark is cut into blocks of at most ``BLOCK_WINDOWS`` windows, so what is broadcast at
once has a fixed bound however large the benchmark is. A block is one pass over the documents, without a shuffle, which adds its
hits to those of the passes before; what a pass leaves is written to the shared folder before the next one's block is made, so
no stage, and no executor, holds two. A window that several items share is one entry with the list of its items.
A pass hashes every window of every document with vector operations, looks the hashes up, and
compares the words of each candidate with those of the benchmark window, so a hit is never a collision.

Defined cases: null text has no words; a benchmark item without text has no window; an item
without an id still marks words but is not listed; several rows with one item_id are one item;
an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.columns import Words, scratch_table, slices, text_bytes

N = 10
#: Windows of one broadcast block: about 100 bytes each, 50 MB at most.
BLOCK_WINDOWS = 500_000
#: Windows of an item that are kept together.
CHUNK_WINDOWS = 4_096


def benchmark_chunks(bench: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """Normalised benchmark words in chunks that overlap by n - 1 words: item, words, windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            item, words, windows = [], [], []
            w = Words(*text_bytes(b.column("text")))
            for d, name in enumerate(b.column("item").to_pylist()):
                lo, hi = int(w.first[d]), int(w.first[d + 1])
                for i in range(lo, max(hi - n + 1, min(hi, lo + 1)), CHUNK_WINDOWS):
                    m = min(CHUNK_WINDOWS + n - 1, hi - i)
                    item.append(name)
                    words.append(w.joined(i, m))
                    windows.append(max(1, m - n + 1))
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(words, pa.binary()),
                                              pa.array(windows, pa.int64())], ["item", "words", "windows"])

    return bench.select(F.col(id_col).cast("string").alias("item"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
                        ).mapInArrow(run, "item string, words binary, windows long")


class Block:
    """The distinct windows of one block: sorted hashes by length, the words to verify a hit, and each window's items."""

    def __init__(self, chunks: list[tuple[str | None, bytes]], n: int):
        self.chunks = chunks
        #: length -> (hash, chunk, first byte, byte after the last) of each distinct window, by hash; and its items.
        self.by_length: dict[int, np.ndarray] = {}
        self.items: dict[int, list[tuple[str, ...]]] = {}
        found: dict[int, list[np.ndarray]] = {}
        for c, (_, words) in enumerate(chunks):
            w = Words(np.frombuffer(words, np.uint8), np.array([0, len(words)], np.int64))
            k = min(n, len(w))
            h, _ = w.grams(k)
            i = np.arange(len(h))
            found.setdefault(k, []).append(np.stack([h, np.full(len(h), c, np.uint64), w.start[i].astype(np.uint64),
                                                     w.end[i + k - 1].astype(np.uint64)]))
        for k, parts in found.items():
            a = np.concatenate(parts, axis=1)
            a = a[:, np.argsort(a[0], kind="stable")]
            kept, items, last, own = [], [], None, {}
            for j, h in enumerate(a[0].tolist()):
                if h != last:
                    last, own = h, {}
                name, words = chunks[int(a[1, j])][0], self._words(a, j)
                if words not in own:
                    own[words] = len(kept)
                    kept.append(j)
                    items.append(set())
                if name is not None:
                    items[own[words]].add(name)
            self.by_length[k], self.items[k] = a[:, kept], [tuple(x) for x in items]

    def _words(self, a: np.ndarray, j: int) -> bytes:
        return self.chunks[int(a[1, j])][1][int(a[2, j]):int(a[3, j])]

    def hits(self, w: Words) -> Iterator[tuple[int, int, int]]:
        """(first word, length, entry) of every verified occurrence."""
        for k, a in self.by_length.items():
            h, inside = w.grams(k)
            lo = np.searchsorted(a[0], h)
            found = (a[0][np.minimum(lo, a.shape[1] - 1)] == h) & inside
            for i in np.flatnonzero(found).tolist():
                own, j = w.joined(i, k), int(lo[i])
                while j < a.shape[1] and a[0, j] == h[i]:  # distinct windows of one hash: collisions only
                    if self._words(a, j) == own:
                        yield i, k, j
                        break
                    j += 1


def scan(docs: DataFrame, bench: DataFrame, n: int = N, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: doc_id, text, n_words, n_hit, items (sorted ids of the items whose
    windows occur), spans (first word and word after the last of each maximal hit run, flattened)."""
    spark = docs.sparkSession
    chunks = benchmark_chunks(bench, n, item_col, item_text_col)
    total = chunks.agg(F.sum("windows")).first()[0] or 0
    # Twice as many blocks as needed on average, so that uneven hashing stays inside the bound.
    blocks = 1 if total <= block_windows else -(-2 * total // block_windows)
    out = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                      F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                      F.array().cast("array<string>").alias("items"), F.array().cast("array<int>").alias("spans"))
    schema = out.schema
    for b in range(blocks):
        own = chunks if blocks == 1 else chunks.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == b)
        sent = spark.sparkContext.broadcast(Block([(r[0], bytes(r[1])) for r in own.select("item", "words").collect()], n))
        out = out.mapInArrow(_pass(sent), schema)
        if b + 1 < blocks:
            out = scratch_table(out, "decontam-pass")
            sent.destroy()
    return out


def _pass(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = sent.value
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                b = batch.slice(lo, hi - lo)
                w = Words(*text_bytes(b.column("text")))
                depth = np.zeros(len(w) + 1, np.int32)
                entries: dict[int, set] = {}
                for i, k, j in block.hits(w):
                    depth[i] += 1
                    depth[i + k] -= 1
                    entries.setdefault(int(np.searchsorted(w.first, i, side="right")) - 1, set()).add((k, j))
                before_items, before_spans = b.column("items"), b.column("spans")
                for d, s in enumerate(before_spans.to_pylist()):  # hits of earlier blocks
                    for x, y in zip(s[0::2], s[1::2], strict=True):
                        depth[w.first[d] + x] += 1
                        depth[w.first[d] + y] -= 1
                hit = np.cumsum(depth[:-1]) > 0
                edge = np.zeros(len(w) + 1, bool)
                edge[1:-1] = hit[1:] != hit[:-1]
                if len(w):
                    edge[0], edge[-1] = hit[0], hit[-1]
                inner = w.first[(w.first > 0) & (w.first < len(w))]
                both = np.unique(inner[hit[inner] & hit[inner - 1]]) if len(w) else inner
                edge[both] = False
                at = np.sort(np.concatenate([np.flatnonzero(edge), both, both])).reshape(-1, 2)
                spans: list[list[int]] = [[] for _ in range(len(b))]
                for x, y in at.tolist():
                    d = int(np.searchsorted(w.first, x, side="right")) - 1
                    spans[d] += [x - int(w.first[d]), y - int(w.first[d])]
                total = np.concatenate([[0], np.cumsum(hit)])
                names = [sorted(set(old or ()).union(*(block.items[k][j] for k, j in entries.get(d, ()))))
                         for d, old in enumerate(before_items.to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("text"), pa.array(np.diff(w.first), pa.int64()),
                     pa.array(total[w.first[1:]] - total[w.first[:-1]], pa.int64()),
                     pa.array(names, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.int32()))],
                    ["doc_id", "text", "n_words", "n_hit", "items", "spans"])
    return run


def contamination_report(docs: DataFrame, bench: DataFrame, **how) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    return scan(docs, bench, **how).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def remove_spans(docs: DataFrame, bench: DataFrame, **how) -> DataFrame:
    """doc_id and text without the hit words (from the first byte of a run's first word to the last of its last)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column("text"))
            w = Words(data, off)
            out = []
            for d, s in enumerate(b.column("spans").to_pylist()):
                keep, at = [], int(off[d])
                for x, y in zip(s[0::2], s[1::2], strict=True):
                    keep.append(data[at:w.start[w.first[d] + x]].tobytes())
                    at = int(w.end[w.first[d] + y - 1])
                out.append(b"".join([*keep, data[at:off[d + 1]].tobytes()]).decode())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    found = scan(docs, bench, **how).select("doc_id", "text", "spans")
    return found.mapInArrow(run, found.select("doc_id", "text").schema)


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **how) -> DataFrame:
    """``docs`` without the documents in which a benchmark window occurs, all columns as they were.

    The whole row travels through the scan as a struct beside the text, so a repeated or null id is no matter."""
    row = F.struct(*[F.col(c) for c in docs.columns])
    out = scan(docs.select(row.alias("row"), F.col(text_col).alias("body")), bench, id_col="row", text_col="body", **how)
    return out.filter(F.col("n_hit") == 0).select("doc_id.*")
