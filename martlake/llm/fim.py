"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of about ``FRAME_BYTES`` bytes each, cut after a line end where
there is one (else between two code points), with the number of line ends, code points and bytes up to the end of each frame.
A cut after k lines is found by binary search in those counts, and only the frame that holds it is decompressed. The
output is again a list of frames: marker frames, the stored frames that lie wholly inside a part as they are, and the
pieces of the cut frames. Digests stream through the frames in order, so no step but the storing holds more than a frame of text.

Lines are the matches of ``[^\\n]*\\n|[^\\n]+``. The draw of a document (where it is cut, and in which form) comes from the SHA-256 of
``seed:id``, so it depends on neither files nor partitions.

Defined cases: a null text is the empty text; empty texts and texts that contain a marker are left plain; a null id is
drawn as the empty string; rows of one id get the same draw, each on its own text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.columns import id_text, slices, with_fields

FRAME_BYTES = 64 << 10
LEVEL = 3
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Order of the parts in each form, by their markers.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
SEED = 7
#: Shares of texts, in percent, that are transformed at all, and of those the ones in suffix-first form.
RATE, SPM_RATE = 100, 50

_FRAME = "struct<data:binary,lines:bigint,chars:bigint,bytes:bigint>"


@cache
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()


def _pack(data: bytes) -> bytes:
    return _codec()[0].compress(data)


def _unpack(frame: bytes) -> bytes:
    return _codec()[1].decompress(frame)


@cache
def _marker(text: str) -> bytes:
    return _pack(text.encode())


def _chars(data: bytes) -> int:
    return len(data.decode())


def cut_frames(data: bytes, size: int = FRAME_BYTES) -> Iterator[bytes]:
    """``data`` (UTF-8) in stretches of at most ``size`` bytes (4 at least): cut after a line end, else between code points."""
    at, size = 0, max(size, 4)
    while len(data) - at > size:
        end = data.rfind(b"\n", at, at + size) + 1
        if end <= at:
            end = at + size
            while data[end] & 0xC0 == 0x80:
                end -= 1
        yield data[at:end]
        at = end
    if at < len(data):
        yield data[at:]


def frames_of(text: str, size: int = FRAME_BYTES) -> list[dict]:
    """Frames of a text with the line ends, code points and bytes up to the end of each."""
    out, lines, chars, total = [], 0, 0, 0
    for part in cut_frames(text.encode(), size):
        lines, chars, total = lines + part.count(b"\n"), chars + _chars(part), total + len(part)
        out.append({"data": _pack(part), "lines": lines, "chars": chars, "bytes": total})
    return out


class Stored:
    """A stored text: seeks by line, without decompressing what lies between."""

    def __init__(self, frames: list[dict]):
        self.data = [f["data"] for f in frames]
        self.lines = [f["lines"] for f in frames]
        self.chars = [f["chars"] for f in frames]

    def seek(self, k: int) -> tuple[int, bytes, bytes]:
        """(frame, its bytes before the cut, its bytes after it) of the cut after k lines."""
        if k == 0:
            return 0, b"", b""
        i = bisect_left(self.lines, k)
        if i == len(self.lines):  # after the last line, which has no line end
            return i, b"", b""
        data = _unpack(self.data[i])
        if k == self.lines[i]:
            at = data.rfind(b"\n") + 1
        else:
            at = 0
            for _ in range(k - (self.lines[i - 1] if i else 0)):
                at = data.index(b"\n", at) + 1
        return (i + 1, b"", b"") if at == len(data) else (i, data[:at], data[at:])

    def chars_to(self, cut: tuple[int, bytes, bytes]) -> int:
        i, head, _ = cut
        return (self.chars[i - 1] if i else 0) + (_chars(head) if head else 0)

    def between(self, a: tuple[int, bytes, bytes], b: tuple[int, bytes, bytes]) -> list[bytes]:
        """Frames of the text between two cuts: whole ones as they are stored."""
        if a[0] == b[0]:
            mid = b[1][len(a[1]):]
            return [_pack(mid)] if mid else []
        first = [_pack(a[2])] if a[2] else []
        whole = self.data[a[0] + bool(a[1] or a[2]):b[0]]
        return first + whole + ([_pack(b[1])] if b[1] else [])


def draw(name: str | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the id."""
    h = hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()
    return tuple(int(h[i:i + 8], 16) for i in range(0, 32, 8))


def stream(frames: Iterable[bytes]) -> Iterator[bytes]:
    """The text of frames in order, a frame at a time."""
    for f in frames:
        yield _unpack(f)


def digest(parts: Iterable[bytes]) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(p)
    return h.hexdigest()


def parts_of(frames: list[bytes], form: str) -> dict[str, list[tuple[int, int, int]]]:
    """Where the parts of an output stand: marker -> (frame, from, to) in order. No marker runs across
    frames, since :func:`transform` writes each as a frame of its own."""
    order, spans, nth = FORMS[form], {m: [] for m in FORMS[form]}, -1
    for i, data in enumerate(stream(frames)):
        at = 0
        while nth + 1 < len(order) and (found := data.find(order[nth + 1].encode(), at)) >= 0:
            if nth >= 0 and found > at:
                spans[order[nth]].append((i, at, found))
            nth += 1
            at = found + len(order[nth])
        if nth >= 0 and at < len(data):
            spans[order[nth]].append((i, at, len(data)))
    return spans


def restored(frames: list[bytes], form: str) -> Iterator[bytes]:
    """The text again, from an output and its form alone."""
    if form == "plain":
        yield from stream(frames)
        return
    spans = parts_of(frames, form)
    last, data = None, b""
    for marker in (PREFIX, MIDDLE, SUFFIX):
        for i, lo, hi in spans[marker]:
            if i != last:
                last, data = i, _unpack(frames[i])
            yield data[lo:hi]


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """doc_id, n (lines), marked (the text contains a marker), frames of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("data", pa.binary()), ("lines", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64())]))
        for b in batches:
            for lo, hi in slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                texts = part.column("text").to_pylist()
                n = [t.count("\n") + bool(t and t[-1] != "\n") for t in texts]
                marked = [PREFIX in t or SUFFIX in t or MIDDLE in t for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(marked, pa.bool_()),
                     pa.array([frames_of(t, frame_bytes) for t in texts], kind)], ["doc_id", "n", "marked", "frames"])

    own = id_text(docs, id_col, text_col)
    return own.mapInArrow(run, with_fields(own, f"n long, marked boolean, frames array<{_FRAME}>"))


def _transform(name: object, n: int, marked: bool, frames: list[dict], seed: int, rate: int, spm_rate: int) -> tuple:
    h1, h2, h3, h4 = draw(name, seed)
    if not frames or marked or h3 % 100 >= rate:
        return "plain", None, None, [f["data"] for f in frames]
    text = Stored(frames)
    a, b = (text.seek(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    end = (len(frames), b"", b"")
    part = {PREFIX: text.between((0, b"", b""), a), MIDDLE: text.between(a, b), SUFFIX: text.between(b, end)}
    form = "spm" if h4 % 100 < spm_rate else "psm"
    out = [f for m in FORMS[form] for f in (_marker(m), *part[m])]
    before = text.chars_to(a)
    return form, before, text.chars_to(b) - before, out


def transform(stored: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output (its zstandard frames in order) of stored texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column("name").to_pylist()
            for lo in range(0, len(b), 256):
                part = b.slice(lo, 256)
                got = [_transform(*x, seed, rate, spm_rate) for x in zip(
                    names[lo:lo + 256], *(part.column(c).to_pylist() for c in ("n", "marked", "frames")), strict=True)]
                form, before, middle, out = zip(*got, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n"), pa.array(form), pa.array(before, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(out, pa.list_(pa.binary()))],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    own = stored.select("doc_id", F.col("doc_id").cast("string").alias("name"), "n", "marked", "frames")
    return own.mapInArrow(run, with_fields(own, "n long, form string, prefix_chars long, middle_chars long, output array<binary>"))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """:func:`transform` of the texts of ``docs``."""
    return transform(store(docs, id_col, text_col), **how)


def output_text(done: DataFrame) -> DataFrame:
    """doc_id, form, text: the outputs decompressed, for writing training text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [b"".join(stream(f)).decode() for f in b.column("output").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("form"), pa.array(text, pa.string())],
                                             ["doc_id", "form", "text"])

    return done.select("doc_id", "form", "output").mapInArrow(run, with_fields(done, "form string, text string"))


def restore(done: DataFrame) -> DataFrame:
    """doc_id, text: the exact texts again, from outputs and forms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [b"".join(restored(f, form)).decode() for form, f in zip(
                b.column("form").to_pylist(), b.column("output").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(text, pa.string())], ["doc_id", "text"])

    return done.select("doc_id", "form", "output").mapInArrow(run, with_fields(done, "text string"))


def fim_report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and the SHA-256 of the output and of the text rebuilt from it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            forms, outputs = b.column("form").to_pylist(), b.column("output").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars")),
                 pa.array([digest(stream(f)) for f in outputs], pa.string()),
                 pa.array([digest(restored(f, x)) for x, f in zip(forms, outputs, strict=True)], pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])

    done = fill_in_middle(docs, **how)
    return done.mapInArrow(run, with_fields(done, "n long, form string, prefix_chars long, middle_chars long, "
                                                  "output_sha256 string, restored_sha256 string"))
