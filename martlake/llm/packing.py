"""Packing of documents into rows of a fixed number of token ids.

A document's ids, closed by an end id, are cut losslessly into segments of at most ``length``. Segments are
packed best-fit-decreasing: the longest first, each into the open row with the least room that still takes
it. The search for that room is a segment tree over the capacities 0..length, whose leaves hold the
open rows of that capacity. Packing runs in blocks of about ``BLOCK_TOKENS`` ids inside the
scanning task, so no text and no id is shuffled, memory is bounded, and a lost task is redone from its split;
against one global packing this costs at most a few part-filled rows per block.

Each row carries its id matrix line (little-endian int32, padded), its segments' cumulative lengths, the
position ids that restart at each segment, and where each segment comes from, so every document can be put together again.

Defined cases: null text is empty and yields the end id alone; repeated rows are packed each on its own;
an empty table yields no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martlake.llm.columns import id_text, slices, text_bytes
from martlake.llm.pieces import Memo, byte_lengths, once, piece_ids, spread, white_cuts

LENGTH = 2048
BLOCK_TOKENS = 4 << 20
#: Slices whose distinct pieces are looked up at once.
SLICES = 4
#: Distinct pieces that one Python worker remembers, about 200 bytes each.
REMEMBERED = 1_000_000


class Capacities:
    """Segment tree over capacities: ``best(n)`` is the least capacity >= n that an open row has."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.filled = bytearray(2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        node = capacity + self.size
        while node and not self.filled[node]:
            self.filled[node] = 1
            node >>= 1

    def take(self, capacity: int) -> int:
        row = self.rows[capacity].pop()
        if not self.rows[capacity]:
            node = capacity + self.size
            self.filled[node] = 0
            while node > 1 and not self.filled[node ^ 1]:
                node >>= 1
                self.filled[node] = 0
        return row

    def best(self, n: int) -> int | None:
        filled, node = self.filled, n + self.size
        if filled[node]:
            return n
        while node > 1 and (node & 1 or not filled[node + 1]):  # up to the first filled tree on the right
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.size:  # down to its leftmost filled leaf
            node = 2 * node if filled[2 * node] else 2 * node + 1
        return node - self.size


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Rows of segment numbers; equal lengths in their given order."""
    tree, rows = Capacities(capacity), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        room = tree.best(n)
        if room is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = tree.take(room)
        rows[row].append(i)
        if room > n:
            tree.add(room - n, row)
    return rows


def _memo(path: str) -> Memo:
    def make():
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        size = byte_lengths(t)
        return Memo(lambda new: piece_ids(t, size, new), REMEMBERED)
    return once(("ids", path), make)


def _pack(docs: list[tuple[object, bytes]], length: int, pad: int, kind: pa.DataType) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join([d[1] for d in docs]), "<i4")
    n = np.array([len(d[1]) // 4 for d in docs], np.int64)
    parts = -(-n // length)
    of = np.repeat(np.arange(len(docs)), parts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = nth * length
    size = np.minimum(n[of] - begin, length)
    at = (np.cumsum(n) - n)[of] + begin
    rows = best_fit_decreasing(size, length)
    matrix = np.full((len(rows), length), pad, "<i4")
    position = np.zeros((len(rows), length), "<i4")
    names, starts, ends = [], [], []
    for r, segments in enumerate(rows):
        col, cu = 0, [0]
        for s in segments:
            k = int(size[s])
            matrix[r, col:col + k] = ids[at[s]:at[s] + k]
            position[r, col:col + k] = np.arange(k)
            col += k
            cu.append(col)
        names.append([docs[of[s]][0] for s in segments])
        starts.append(begin[segments].tolist())
        ends.append(cu)
    width = pa.binary(4 * length)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.list_(kind)), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int32())),
         pa.array([c[-1] for c in ends], pa.int32()), _fixed(matrix, width), _fixed(position, width)],
        ["doc_ids", "doc_starts", "cu_seqlens", "n_tokens", "ids", "position_ids"])


def _fixed(a: np.ndarray, width: pa.DataType) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(width, len(a), [None, pa.py_buffer(a.tobytes())]).cast(pa.binary())


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, length: int = LENGTH, pad_id: int | None = None,
         block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per packed line: doc_ids, doc_starts (first id of each segment within its document), cu_seqlens,
    n_tokens, ids and position_ids (little-endian int32, ``length`` of each; ids padded by ``pad_id``, else the end id)."""
    own = id_text(docs, id_col, text_col)
    kind = own.schema["doc_id"].dataType.simpleString()
    pad = end_id if pad_id is None else pad_id
    end = np.asarray([end_id], "<i4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, total, typ = _memo(tokenizer_path), [], 0, None
        for b in batches:
            typ = b.schema.field("doc_id").type
            cuts = list(slices(b.column("text")))
            for k in range(0, len(cuts), SLICES):
                first = cuts[k][0]
                part = b.slice(first, cuts[k:k + SLICES][-1][1] - first)
                data, offsets = text_bytes(part.column("text"))
                ids, ends, _ = spread(data, offsets, white_cuts(data), memo.values)
                names, ends = part.column("doc_id").to_pylist(), ends.tolist()
                for lo, hi in cuts[k:k + SLICES]:
                    for i in range(lo - first, hi - first):
                        held.append((names[i], ids[ends[i]:ends[i + 1]].tobytes() + end))
                        total += len(held[-1][1]) // 4
                    if total >= block_tokens:
                        yield _pack(held, length, pad, typ)
                        held, total = [], 0
        if held:
            yield _pack(held, length, pad, typ)

    return own.mapInArrow(run, f"doc_ids array<{kind}>, doc_starts array<long>, cu_seqlens array<int>, n_tokens int, "
                               "ids binary, position_ids binary")


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet; each file's ids column is a matrix of its rows."""
    packed.write.parquet(path)
