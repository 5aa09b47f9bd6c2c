"""Shared helpers: text columns as byte arrays, words, hashes, and shared scratch tables.

Every operator reads only its id and text columns, under names of its own, so extra
columns of a table (whatever they are called) never clash with what it computes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.session import scratch_path

#: Bytes of text that a kernel works on at once; one longer text is worked on alone.
SLICE_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, null text read as empty."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def with_fields(own: DataFrame, ddl: str, field: str = "doc_id") -> T.StructType:
    """Schema of the field as it is in ``own`` (a struct too) and the fields of ``ddl``."""
    return T.StructType([own.schema[field], *T.StructType.fromDDL(ddl).fields])


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts the lineage)."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (finaliser of a counter-based generator)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i < n."""
    p = np.full(n, base, dtype=np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


#: Powers for the bytes of one part; those of longer texts are products with a power of the part's place, so no table is of a text's size.
_PART_BITS = 14
_PART = 1 << _PART_BITS
_POWERS, _INVERSE = _powers(_BASE, _PART), _powers(_BASE_INV, _PART)
_PART_BASE, _PART_INV = pow(_BASE, _PART, 1 << 64), pow(_BASE_INV, _PART, 1 << 64)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which :func:`range_hash` takes the hash of any byte range."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    for k, scale in enumerate(_powers(_PART_BASE, -(-len(data) // _PART))):
        lo = k * _PART
        part = data[lo:lo + _PART].astype(np.uint64)
        part += np.uint64(1)
        part *= _POWERS[:len(part)]
        part *= scale
        part[:1] += out[lo]
        np.cumsum(part, out=out[lo + 1:lo + 1 + len(part)])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end], the same wherever the bytes stand."""
    out = prefix[end] - prefix[start]
    out *= _INVERSE[start & (_PART - 1)]
    out *= _powers(_PART_INV, len(prefix) // _PART + 1)[start >> _PART_BITS]
    return mix64(out)


def slices(col: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of an Arrow string column of about ``most`` bytes each, whole rows only."""
    if not len(col):
        return
    size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin, total = 0, 0
    for i, n in enumerate(size.tolist()):
        if total and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    yield begin, len(col)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string column and the offsets of its rows (null: empty)."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64, len(col) + 1, col.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def _lower_table() -> bytes:
    t = bytearray(256)
    for b in range(256):
        if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A:
            t[b] = b
        elif 0x41 <= b <= 0x5A:
            t[b] = b + 32
    return bytes(t)


_LOWER = _lower_table()


class Words:
    """Words of many texts: runs of ASCII letters (lower-cased), digits and non-ASCII bytes.

    ``start``/``end`` are byte ranges in the joined texts, ``hash`` a 64-bit hash of the
    lower-cased word, ``first[d]:first[d+1]`` the words of text ``d``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = np.frombuffer(data.tobytes().translate(_LOWER), np.uint8)
        word = low != 0
        edge = np.empty(len(data) + 1, dtype=bool)
        edge[1:-1] = word[1:] != word[:-1]
        edge[0] = edge[-1] = False
        inner = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
        if len(data):
            edge[0], edge[-1] = word[0], word[-1]
        both = inner[word[inner] & word[inner - 1]]  # a word that would run across two texts
        edge[both] = False
        at = np.flatnonzero(edge)
        if len(both):
            at = np.sort(np.concatenate([at, both, both]))
        self.low, self.start, self.end = low, at[0::2], at[1::2]
        self.prefix = prefix_hash(low)
        self.hash = range_hash(self.prefix, self.start, self.end)
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each word on, and whether they lie in one text."""
        if len(self) < n:
            return np.empty(0, np.uint64), np.empty(0, bool)
        m = len(self) - n + 1
        acc = self.hash[:m].copy()
        for j in range(1, n):
            acc *= np.uint64(0x9FB21C651E98DF25)
            acc += self.hash[j:j + m]
        last = np.repeat(self.first[1:], np.diff(self.first))
        return mix64(acc), np.arange(m) + n <= last[:m]

    def joined(self, i: int, n: int) -> bytes:
        """n words from word i on, lower-cased, with a blank between."""
        return b" ".join(self.low[s:e].tobytes() for s, e in zip(self.start[i:i + n], self.end[i:i + n], strict=True))


def crc_mod(id_col: str, m: int) -> F.Column:
    """crc32 of the id as text, modulo m: the fixed fold of a labelled row."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % m
