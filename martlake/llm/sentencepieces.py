"""SentencePiece models run by the tokenizers library.

The model protobuf is parsed field by field (no protobuf runtime), and its parts are rebuilt: the
normaliser (character map if the model has one, dummy prefix, white-space rules), the metaspace marker,
the pieces with their scores (a unigram model, or a merge list ordered by score), and byte fallback.
No piece of such a vocabulary carries the marker after another character (checked at load), so the
tokens of a text are those of its marker-led chunks in a row: batches of distinct chunks are encoded,
many as one string where the tokens show the cuts, and remembered. Parity is verified, not assumed: the sentencepiece library
encodes each distinct chunk too, and where the two differ its ids are taken and ``parity`` is false. Texts are decoded from their ids.

Defined cases: null text is the empty text with no tokens; characters outside the vocabulary become byte
pieces; the marker character inside a text decodes as a blank, the only text that does not round-trip.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.columns import id_text, slices, text_bytes, with_fields
from martlake.llm.pieces import JOINED, Memo, once, spread

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Distinct chunks that one Python worker remembers during a task, about 200 bytes each.
REMEMBERED = 200_000


def _fields(buf: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protobuf message: ints for varints, bytes for the rest."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = buf[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(buf):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        n = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, buf[at:at + n]
        at += n


class Model:
    """The parts of a model file that decide how text is encoded."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            raw = f.read()
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.byte_fallback, self.unk_id = UNIGRAM, False, 0
        self.charsmap, self.dummy_prefix, self.squeeze, self.escape = b"", True, True, True
        for number, value in _fields(raw):
            if number == 1:
                p = dict(_fields(value))
                self.pieces.append((p.get(1, b"").decode(), struct.unpack("<f", p.get(2, bytes(4)))[0], p.get(3, NORMAL)))
            elif number == 2:
                t = dict(_fields(value))
                self.kind, self.byte_fallback = t.get(3, UNIGRAM), bool(t.get(35, 0))
            elif number == 3:
                n = dict(_fields(value))
                self.charsmap, self.dummy_prefix = n.get(2, b""), bool(n.get(3, 1))
                self.squeeze, self.escape = bool(n.get(4, 1)), bool(n.get(5, 1))
        self.unk_id = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        usable = [p for p, _, t in self.pieces if t in (NORMAL, USER)]
        #: Whether texts may be cut before each run of markers.
        self.cuttable = self.escape and self.dummy_prefix and not any(re.search(f"[^{MARK}]{MARK}", p) for p in usable)

    def merges(self) -> list[tuple[str, str]]:
        """Pairs that form a piece, the piece of the best score first."""
        rank = {p: s for p, s, t in self.pieces if t in (NORMAL, USER, UNUSED)}
        out = []
        for piece, score in rank.items():
            for cut in range(1, len(piece)):
                a, b = piece[:cut], piece[cut:]
                if a in rank and b in rank:
                    out.append((-score, -rank[a], -rank[b], a, b))
        out.sort()
        return [(a, b) for _, _, _, a, b in out]

    def tokenizer(self):
        """(tokenizer without normaliser, normaliser)."""
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers
        if self.kind == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in self.pieces], self.unk_id, self.byte_fallback)
        elif self.kind == BPE:
            core = models.BPE({p: i for i, (p, _, _) in enumerate(self.pieces)}, self.merges(),
                              unk_token=self.pieces[self.unk_id][0], fuse_unk=True, byte_fallback=self.byte_fallback)
        else:
            raise ValueError(f"model type {self.kind}: only unigram and BPE models are read")
        t = Tokenizer(core)
        t.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
                                       *[decoders.Strip(" ", 1, 0)] * self.dummy_prefix])
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.squeeze:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if self.escape else " "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        return t, normalizers.Sequence(steps)


class Codec:
    """Encoder and decoder of one model in one Python worker."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = Model(path)
        self.tokenizer, self.normalizer = self.model.tokenizer()
        self.reference = SentencePieceProcessor(model_file=path)
        #: Whether the normaliser only puts a marker first and in place of blanks.
        self.plain = self.model.dummy_prefix and self.model.escape and not self.model.charsmap and not self.model.squeeze
        #: What each id decodes to.
        self.table = [bytes([int(p[3:5], 16)]) if t == BYTE else p.replace(MARK, " ").encode() for p, _, t in self.model.pieces]
        self.size = np.array([len(x) for x in self.table], np.int64)
        self.column = pa.array(self.table, pa.large_binary())
        self.memo = Memo(self._make, REMEMBERED)

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the blank that the encoder puts first: as the library decodes them, which is asked
        itself where byte pieces do not make up characters."""
        try:
            text = b"".join([self.table[i] for i in ids]).decode()
        except (UnicodeDecodeError, IndexError):
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """:meth:`decode` of each text's ids, ids[ends[i]:ends[i + 1]]."""
        _, off, data = self.column.take(pa.array(ids)).buffers()
        data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
        off = np.frombuffer(off, np.int64)[ends] if len(ids) else np.zeros_like(ends)
        if self.model.dummy_prefix:
            lead = off[:-1][np.diff(off) > 0]
            lead = lead[data[lead] == 0x20]
            data, off = np.delete(data, lead), off - np.searchsorted(lead, off)
        try:
            return pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(data)]).cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([self.decode(ids[a:z].tolist()) for a, z in zip(ends[:-1], ends[1:], strict=True)], pa.large_string())

    def _normalized(self, col: pa.Array) -> pa.Array:
        if not self.plain:
            return pa.array([self.normalizer.normalize_str(t) if t else "" for t in col.to_pylist()], pa.large_string())
        col = col.cast(pa.large_string())
        led = pc.replace_substring(pc.binary_join_element_wise(pa.scalar(MARK, pa.large_string()), col, pa.scalar("", pa.large_string())), " ", MARK)
        return pc.if_else(pc.equal(pc.binary_length(col), 0), col, led)

    def _cuts(self, data: np.ndarray) -> np.ndarray:
        """Places of the runs of markers."""
        if not self.model.cuttable:
            return np.empty(0, np.int64)
        at = np.flatnonzero(data == 0xE2)
        at = at[(data[at + 1] == 0x96) & (data[at + 2] == 0x81)]
        return at[np.diff(at, prepend=-3) != 3]

    def _make(self, new: list[str]) -> list[bytes]:
        """Ids (little-endian int32) of each chunk, and one more byte where the two libraries differ."""
        out: list[bytes | None] = [None] * len(new)
        if self.plain and self.model.cuttable:
            groups = [new[i:i + JOINED] for i in range(0, len(new), JOINED)]
            for k, (group, m, t) in enumerate(zip(groups, *self._both(list(map("".join, groups))), strict=True)):
                text = [c.replace(MARK, " ") for c in group]
                if m == t and b"".join([self.table[i] for i in m]) == (whole := "".join(text)).encode():
                    ends = np.cumsum(self.size[m])
                    want = np.cumsum(list(map(len, text if whole.isascii() else map(str.encode, text))))
                    at = np.searchsorted(ends, want)
                    if (ends[at] == want).all():
                        raw, cut = np.asarray(m, "<i4").tobytes(), [0, *(4 * (at + 1)).tolist()]
                        out[k * JOINED:k * JOINED + len(group)] = [raw[a:z] for a, z in zip(cut, cut[1:])]
        alone = [i for i, x in enumerate(out) if x is None]
        for i, m, t in zip(alone, *self._both([new[i] for i in alone]), strict=True):
            # No text is left of a lone marker, for which the library gives nothing.
            differs = m != t and new[i] != (MARK if self.model.escape else "")
            out[i] = np.array(t if differs else m, "<i4").tobytes() + b"!" * differs
        return out

    def _both(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of normalised chunks from the tokenizers and from the sentencepiece library."""
        mine = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        # A chunk starts with the marker, which the library adds as its dummy prefix.
        return mine, self.reference.encode([c.removeprefix(MARK).replace(MARK, " ") if self.model.escape else c for c in chunks], num_threads=1)

    def encode_all(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ends, parity) of an Arrow column of texts: text i has ids[ends[i]:ends[i + 1]]."""
        data, offsets = text_bytes(self._normalized(col))
        ids, ends, differ = spread(data, offsets, self._cuts(data), self.memo.values)
        return ids, ends, differ == 0

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool, str]]:
        """(ids, parity, decoded text) of each text."""
        ids, ends, parity = self.encode_all(pa.array(texts, pa.string()))
        return [(ids[a:z].tobytes(), p, d) for a, z, p, d in
                zip(ends[:-1], ends[1:], parity.tolist(), self.decode_all(ids, ends).to_pylist(), strict=True)]


def codec(path: str) -> Codec:
    return once(("sentencepiece", path), lambda: Codec(path))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>), n_tokens, parity, decoded of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for b in batches:
            for lo, hi in slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                ids, ends, parity = c.encode_all(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                     pa.array(np.diff(ends), pa.int64()), pa.array(parity), c.decode_all(ids, ends).cast(pa.string())],
                    ["doc_id", "ids", "n_tokens", "parity", "decoded"])
        c.memo.clear()  # the worker serves other tasks next, which have little use for it

    own = id_text(docs, id_col, text_col)
    return own.mapInArrow(run, with_fields(own, "ids array<int>, n_tokens long, parity boolean, decoded string"))


def decode(tokens: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text from token ids (null: empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(
                [c.decode(x or []) for x in b.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

    own = tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return own.mapInArrow(run, with_fields(own, "text string"))


def encoding_report(docs: DataFrame, model_path: str, **cols) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as comma-joined decimals), parity, decoded_sha256 of every text."""
    return encode(docs, model_path, **cols).select(
        "doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        "parity", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
