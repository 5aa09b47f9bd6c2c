"""Alignment of two tokenizers' tokens over the same bytes, by galloping intersection.

A is a byte-level BPE of the tokenizers library (over blank + text), B a sentencepiece model (which adds that blank itself).
The ascending byte offsets at which tokens end are the two lists. The shorter one drives an exponential-plus-binary search
into the longer one, done for many entries at once, coarse to fine: an entry starts where its coarser neighbour was found, so half of the
entries gallop one or two places. Offsets found in both lists cut the tokens into groups; the ranks of a driver token's
first and last byte in the other list give the range of tokens that it overlaps, and thereby its links. Neither side has a
token across a blank that follows no white space, so texts are cut there, and what a batch's distinct new pieces give
(all searched as one pair of lists) is remembered, up to a fixed number of pieces.

The corpus-wide count of each linked id pair needs a second look at every document. The first pass writes each document's links
(sorted 32-bit pairs) to the shared folder; a pair count is then a pre-aggregated sum. The most frequent pairs, as many whole powers of two
of counts as fit ``HEAD_PAIRS``, and the highest count of each B id (a vocabulary, so bounded) are broadcast and settle their links
where they are read; links of the rarer pairs (none of them frequent, so no key is hot) are counted by an ordinary join.

Defined cases: null and empty texts, and texts whose joined A or B bytes are not blank + text (for instance any that contains the
marker character), have no tokens, zeros and an empty ``groups_sha256``; rows of one id are documents of their own; special
strings are ordinary text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.llm.columns import id_text, scratch_table, slices, with_fields
from martlake.llm.pieces import _SPACE, Memo, once, piece_ids
from martlake.llm.sentencepieces import BYTE, MARK, Model

#: Pairs whose counts are broadcast, at most.
HEAD_PAIRS = 1 << 19
#: Distinct pairs that a counting task holds before it passes them on.
HELD_PAIRS = 1 << 20


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each entry of the ascending list ``short`` the first place of the ascending list ``long`` that is not below it."""
    n, m = len(short), len(long)
    found = np.zeros(n, np.int64)
    stride = 1 << max(n - 1, 0).bit_length()
    while stride:
        at = np.arange(0, n, stride) if stride >= n else np.arange(stride, n, 2 * stride)
        lo = found[at - stride] if stride < n else np.zeros(len(at), np.int64)
        _search(short, long, at, lo, found, m)
        stride >>= 1
    return found


def _search(short: np.ndarray, long: np.ndarray, at: np.ndarray, lo: np.ndarray, found: np.ndarray, m: int) -> None:
    """Exponential search from ``lo`` for the entries ``at``, then binary search in the stretch that it leaves."""
    want, step = short[at], 1
    hi = np.full(len(at), m, np.int64)
    open_ = np.arange(len(at))
    while len(open_):  # long[lo - 1] < want holds throughout
        probe = lo[open_] + step - 1
        inside = probe < m
        below = np.zeros(len(open_), bool)
        below[inside] = long[probe[inside]] < want[open_[inside]]
        stop = open_[~below]
        hi[stop] = np.minimum(lo[stop] + step - 1, m)
        open_ = open_[below]
        lo[open_] += step
        step *= 2
    open_ = np.flatnonzero(lo < hi)
    while len(open_):
        mid = (lo[open_] + hi[open_]) >> 1
        below = long[mid] < want[open_]
        lo[open_[below]] = mid[below] + 1
        hi[open_[~below]] = mid[~below]
        open_ = open_[lo[open_] < hi[open_]]
    found[at] = lo


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A places, B places of the common ends, A place, B place of each overlapping pair) of two
    ascending lists of ends over the same bytes, whose last entries are equal."""
    swap = len(a_end) > len(b_end)
    drive, other = (b_end, a_end) if swap else (a_end, b_end)
    last = gallop(drive, other)  # the other side's token that holds the last byte of each driver token
    same = other[last] == drive
    first = np.empty_like(last)  # and the one that holds its first byte
    first[:1] = 0
    first[1:] = last[:-1] + same[:-1]
    size = last - first + 1
    d = np.repeat(np.arange(len(drive)), size)
    o = np.arange(len(d)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    common = np.flatnonzero(same), last[same]
    return (common[1], common[0], o, d) if swap else (*common, d, o)


def byte_level() -> dict[str, int]:
    """Characters of the byte-level alphabet and the bytes that they stand for: printable Latin-1 for itself, the others from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Texts may be cut, for both sides, before a blank that follows no white space: A's pre-tokenizer joins no character to white
#: space after it, and no piece of B has its marker after another character.
_PIECE = re.compile(f"[{_SPACE}]*[^{_SPACE}]+(?:(?! )[{_SPACE}]+[^{_SPACE}]+)*(?:(?! )[{_SPACE}]+\\Z)?|[{_SPACE}]+")

#: In place of the groups of a piece whose bytes do not come out.
_BROKEN = b"!"


class Sides:
    """Both encoders of one Python worker, and the alignment of the distinct pieces that it has met: no token
    crosses a cut on either side, so the groups and links of a text are those of its pieces in a row."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        alphabet, vocab = byte_level(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            known = all(c in alphabet for c in token)
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        model = Model(b_path)
        self.b = SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if t == BYTE else p.replace(MARK, " ").encode() for p, _, t in model.pieces]
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 16:
            raise ValueError("vocabularies of more than 65,536 ids are not supported")
        #: Whether B's pieces can be encoded alone: none runs across a cut, and the text reaches them unchanged.
        self.alone = model.cuttable and not model.charsmap and not model.squeeze
        self.names = Names(max(len(self.a_bytes), len(self.b_bytes)))
        self.memo = Memo(self._make)

    def pieces(self, text: str) -> list[str]:
        """Blank + text in pieces; none for a text that has no tokens by definition."""
        if not text or MARK in text:
            return []
        return _PIECE.findall(" " + text) if self.alone else [" " + text]

    def _a_ids(self, new: list[str]) -> list[bytes]:
        """Pieces that end in white space, as a text may, are each encoded alone."""
        last = [p for p in new if _ENDS_BLANK.search(p)]
        rest = [p for p in new if not _ENDS_BLANK.search(p)]
        known = dict(zip(rest, piece_ids(self.a, self.a_size, rest), strict=True))
        for p, e in zip(last, self.a.encode_batch_fast(last, add_special_tokens=False), strict=True):
            known[p] = np.asarray(e.ids, "<i4").tobytes()
        return [known[p] for p in new]

    def _b_ids(self, new: list[str]) -> list[bytes]:
        """Of pieces that begin with a blank, which the library adds itself (but not before nothing)."""
        ids = self.b.encode([p[1:] for p in new], num_threads=1)
        return [np.array(i or ([self.b.piece_to_id(MARK)] if p == " " else []), "<i4").tobytes() for p, i in zip(new, ids, strict=True)]

    @staticmethod
    def _whole(ids: list[bytes], parts: list[bytes], texts: list[bytes]) -> list[bool]:
        """Whether the tokens' bytes are the text's, for each piece."""
        return [b"".join([parts[i] for i in np.frombuffer(x, "<i4").tolist()]) == t for x, t in zip(ids, texts, strict=True)]

    def _make(self, new: list[str]) -> list[tuple[bytes, bytes, bytes]]:
        """(groups as text, links, number of A's tokens) of each piece."""
        a, b, texts = self._a_ids(new), self._b_ids(new), [p.encode() for p in new]
        sure = self._same(a, self.a_bytes, self.a_size, texts) and self._same(b, self.b_bytes, self.b_size, texts)
        good = [True] * len(new) if sure else [x and y for x, y in zip(self._whole(a, self.a_bytes, texts), self._whole(b, self.b_bytes, texts))]
        made = iter(self._align([x for x, ok in zip(a, good) if ok], [x for x, ok in zip(b, good) if ok]))
        return [next(made) if ok else (_BROKEN, b"", b"") for ok in good]

    @staticmethod
    def _same(ids: list[bytes], parts: list[bytes], size: np.ndarray, texts: list[bytes]) -> bool:
        """Whether the tokens' bytes are the texts' for all pieces, seen at once."""
        flat = np.frombuffer(b"".join(ids), "<i4")
        ends = np.concatenate([[0], np.cumsum(size[flat])])[np.cumsum([len(x) // 4 for x in ids])] if len(flat) else np.zeros(len(ids))
        return (ends == np.cumsum([len(t) for t in texts])).all() and b"".join([parts[i] for i in flat.tolist()]) == b"".join(texts)

    def _align(self, a: list[bytes], b: list[bytes]) -> list[tuple[bytes, bytes, bytes]]:
        """All pieces at once: their bytes stand one after the other, so the lists of ends stay ascending."""
        if not a:
            return []
        ia, ib = (np.frombuffer(b"".join(x), "<i4") for x in (a, b))
        a_first, b_first = (np.concatenate([[0], np.cumsum([len(p) // 4 for p in x])]) for x in (a, b))
        a_cut, b_cut, x, y = overlaps(np.cumsum(self.a_size[ia]), np.cumsum(self.b_size[ib]))
        links = ((ia[x].astype(np.int64) << 16) | ib[y]).astype("<u4").tobytes()
        link_first = (4 * np.searchsorted(x, a_first)).tolist()
        names, name_first = self.names.in_groups(ia, ib, a_cut, b_cut), (a_first + b_first).tolist()
        n_a = np.diff(a_first).astype("<u4").tobytes()
        return [(b"".join(names[name_first[i]:name_first[i + 1]]), links[link_first[i]:link_first[i + 1]], n_a[4 * i:4 * i + 4])
                for i in range(len(a))]


_ENDS_BLANK = re.compile(f"[{_SPACE}]\\Z")


class Names:
    """Decimal ids with each of the separators that may follow, for the digests of groups."""

    def __init__(self, n: int):
        self.forms = np.array([[f"{i}{c}".encode() for c in ",|;"] for i in range(n)], object)

    def in_groups(self, a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray) -> list[bytes]:
        """All ids with their separators, group by group, A's before B's; the cuts are the places of the tokens that end a group."""
        turn = [2 * np.searchsorted(cut, np.arange(len(ids))) + k for k, (ids, cut) in enumerate(((a, a_cut), (b, b_cut)))]
        mark = [np.zeros(len(a), np.int8), np.zeros(len(b), np.int8)]
        mark[0][a_cut], mark[1][b_cut] = 1, 2
        order = np.argsort(np.concatenate(turn), kind="stable")
        return self.forms[np.concatenate([a, b])[order], np.concatenate(mark)[order]].tolist()


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and links (each overlapping pair as
    ``A id * 2**16 + B id`` in ascending order, little-endian 32-bit) of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = once(("align", a_path, b_path), lambda: Sides(a_path, b_path))
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *align_texts(sides, part.column("text").to_pylist())],
                                                 ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    own = id_text(docs, id_col, text_col)
    return own.mapInArrow(run, with_fields(own, "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"))


def align_texts(sides: Sides, texts: list[str]) -> list[pa.Array]:
    """The columns n_a, n_b, n_groups, n_links, groups_sha256 and links of texts, put together from their pieces."""
    cut = [sides.pieces(t) for t in texts]
    value = sides.memo.look_up(cut)
    counts, sha, links = [], [], []
    for pieces in cut:
        got = [value(p) for p in pieces]
        groups = b"".join([g[0] for g in got])
        if not groups or _BROKEN in groups:
            counts.append((0, 0, 0, 0))
            sha.append("")
            links.append(b"")
            continue
        pairs = np.frombuffer(b"".join([g[1] for g in got]), "<u4")
        n_a = int(np.frombuffer(b"".join([g[2] for g in got]), "<u4").sum(dtype=np.int64))
        n_groups = groups.count(b"|")
        counts.append((n_a, n_groups + groups.count(b",") + groups.count(b";") - n_a, n_groups, len(pairs)))
        sha.append(hashlib.sha256(groups[:-1]).hexdigest())
        links.append(np.sort(pairs).tobytes())
    columns = list(zip(*counts)) or [()] * 4
    return [*(pa.array(c, pa.int64()) for c in columns), pa.array(sha, pa.string()), pa.array(links, pa.binary())]


def pair_counts(aligned: DataFrame, held: int = HELD_PAIRS) -> DataFrame:
    """pair, n: how many links of all documents hold each id pair; tasks pass on sums over many documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, waiting, size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0
        def fold():
            p, n = np.unique(np.concatenate([known, *waiting]), return_inverse=True)
            weight = np.concatenate([count, np.ones(size, np.int64)])
            return p, np.bincount(n, weight, len(p)).astype(np.int64)
        for b in batches:
            for data in b.column("links"):
                waiting.append(np.frombuffer(data.as_buffer(), "<u4").astype(np.int64))
                size += len(waiting[-1])
                if size >= held:
                    known, count = fold()
                    waiting, size = [], 0
                    if len(known) >= held:
                        yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(count)], ["pair", "n"])
                        known, count = np.empty(0, np.int64), np.empty(0, np.int64)
        known, count = fold()
        yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(count)], ["pair", "n"])

    return (aligned.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))


def add_counts(aligned: DataFrame, counts: DataFrame, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """``aligned`` (a written table) with n_best and count_sum, from the corpus-wide pair counts (a written table too)."""
    spark = aligned.sparkSession
    grade = F.floor(F.log2("n"))
    sizes = sorted(counts.groupBy(grade.alias("g")).count().collect(), reverse=True)  # a row for each power of two
    least, total = 1 << 6, 0
    for g, n in sizes:
        total += n
        if total > head_pairs:
            break
        least = g
    head = counts.filter(grade >= least).toArrow().sort_by("pair")  # at most head_pairs rows
    highest = counts.groupBy((F.col("pair") % 65536).alias("b")).agg(F.max("n").alias("highest"))  # at most a row for each B id
    best = np.zeros(1 << 16, np.int64)
    for b, n in highest.collect():
        best[b] = n
    sent = spark.sparkContext.broadcast((head["pair"].to_numpy(), head["n"].to_numpy(), best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts_, best_ = sent.value
        for b in batches:
            n_best, total_, rare = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64), []
            for d, data in enumerate(b.column("links")):
                p = np.frombuffer(data.as_buffer(), "<u4").astype(np.int64)
                at = np.searchsorted(pairs, p)
                at[at == len(pairs)] = 0
                hit = pairs[at] == p if len(pairs) else np.zeros(len(p), bool)
                n = counts_[at[hit]]
                total_[d] = n.sum()
                n_best[d] = np.count_nonzero(n == best_[p[hit] & 0xFFFF])
                rare.append(p[~hit].tolist())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in b.schema.names if c != "links"), pa.array(n_best), pa.array(total_),
                                              pa.array(rare, pa.list_(pa.int64()))], [c for c in b.schema.names if c != "links"] + ["n_best", "count_sum", "rare"])

    rows = aligned.withColumn("row", F.monotonically_increasing_id())
    kept = [f for f in rows.schema.fields if f.name != "links"]
    settled = scratch_table(rows.mapInArrow(run, _schema(kept, "n_best long, count_sum long, rare array<long>")), "align-settled")
    rare = (settled.select("row", F.explode("rare").alias("pair")).join(counts.filter(grade < least), "pair")
            .withColumn("b", F.col("pair") % 65536).join(F.broadcast(highest), "b")
            .groupBy("row").agg(F.count_if(F.col("n") == F.col("highest")).alias("rare_best"), F.sum("n").alias("rare_sum")))
    return settled.join(rare, "row", "left").select(
        *[f.name for f in kept if f.name != "row"], (F.col("n_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"))


def _schema(fields: list, ddl: str) -> T.StructType:
    return T.StructType([*fields, *T.StructType.fromDDL(ddl).fields])


def alignment_report(docs: DataFrame, a_path: str, b_path: str, head_pairs: int = HEAD_PAIRS, **cols) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    aligned = scratch_table(align(docs, a_path, b_path, **cols), "align-links")
    counts = scratch_table(pair_counts(aligned), "align-counts")
    return add_counts(aligned, counts, head_pairs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
