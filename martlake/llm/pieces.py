"""Safe text pieces and a bounded memo of what a tokenizer makes of them.

A byte-level BPE with the usual pre-tokenizer never joins a character to a white-space character
after it, so a text may be cut before every run of white space: the tokens of the text are
the tokens of its pieces in a row. Pieces repeat, so each distinct piece is encoded once per batch and
kept for later batches of the same Python worker, up to a fixed number.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa

# Encoding runs inside a Spark task, which owns the cores that spark.task.cpus gives it.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
os.environ.setdefault("RAYON_NUM_THREADS", "2")

#: Unicode's White_Space characters, the class that the tokenizers library calls \s.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PIECE = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_BLANK = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{_SPACE}]", c))

#: Pieces that are encoded as one string.
JOINED = 256

#: Distinct pieces that one Python worker remembers, and the longest that it does.
MEMO_PIECES = 400_000
MEMO_CHARS = 48


def safe_pieces(text: str) -> list[str]:
    """``text`` cut before each run of white space; joined they are the text."""
    return _PIECE.findall(text)


_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: The other white-space characters in UTF-8, of two and of three bytes.
_WIDE = [np.array([int.from_bytes(c.encode(), "big") for c in _BLANK if len(c.encode()) == n]) for n in (2, 3)]


def white_cuts(data: np.ndarray) -> np.ndarray:
    """Places in joined UTF-8 texts before an ASCII white-space character that follows none: the cuts of :func:`safe_pieces`
    but for those before other white space."""
    white = _WHITE[data]
    at = np.flatnonzero(white[1:] & ~white[:-1]) + 1
    after = np.flatnonzero(data[at - 1] >= 0x80)
    if len(after):
        last = [data[np.maximum(at[after] - i, 0)].astype(np.int64) for i in (1, 2, 3)]
        two = last[1] << 8 | last[0]
        at = np.delete(at, after[np.isin(two, _WIDE[0]) | np.isin(last[2] << 16 | two, _WIDE[1])])
    return at


def spread(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray, values: Callable[[list[str]], list[bytes]]
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, ends, extra) of joined texts that are cut at ``cuts`` and at their ``offsets``: the ids of all texts in a row, where each
    text's begin and the last one's end, and how many pieces of each text have a value with a byte beyond its little-endian int32
    ids. ``values`` gets the distinct pieces."""
    edge = np.zeros(len(data) + 1, bool)
    edge[cuts] = edge[offsets] = edge[-1] = True
    edge = np.flatnonzero(edge) if len(data) else np.zeros(1, np.int64)
    if edge[0]:
        edge = np.append(0, edge)
    pieces = pa.Array.from_buffers(pa.large_string(), len(edge) - 1, [None, pa.py_buffer(edge), pa.py_buffer(data)]).dictionary_encode()
    made = values(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
    size = np.fromiter(map(len, made), np.int64, len(made))
    odd = size & 3
    if odd.any():
        made = [x[:len(x) & ~3] for x in made]
    size >>= 2
    ids, place = np.frombuffer(b"".join(made), "<i4"), pieces.indices.to_numpy()
    n, cut = size[place], np.searchsorted(edge, offsets)
    ends = np.append(0, np.cumsum(n))
    at = np.repeat((np.cumsum(size) - size)[place] - ends[:-1], n)
    at += np.arange(len(at))
    return ids[at], ends[cut], np.diff(np.append(0, np.cumsum(odd[place] > 0))[cut])


def byte_lengths(tokenizer) -> np.ndarray:
    """Bytes of text that each id of a byte-level vocabulary stands for (one character of its alphabet a byte)."""
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocab.values(), default=-1) + 1, np.int64)
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    for token, i in vocab.items():
        out[i] = len(token.encode()) if token in added else len(token)
    return out


def piece_ids(tokenizer, size: np.ndarray, pieces: list[str]) -> list[bytes]:
    """Ids (little-endian int32) of each piece, ``size`` being the tokenizer's :func:`byte_lengths`.

    Pieces that begin with white space and do not end in it are encoded ``JOINED`` at a time as one string, where
    each may be cut off again, by bytes. Where a cut is not between two ids, and for all other pieces, each is encoded alone."""
    def encode(texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, "<i4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    out: list[bytes | None] = [None] * len(pieces)
    led = [i for i, p in enumerate(pieces) if p[0] in _BLANK and p[-1] not in _BLANK]
    groups = [led[i:i + JOINED] for i in range(0, len(led), JOINED)]
    texts = [[pieces[i] for i in g] for g in groups]
    joined = ["".join(t) for t in texts]
    for own, text, whole, ids in zip(groups, texts, joined, encode(joined), strict=True):
        ends = np.cumsum(size[ids])
        want = np.cumsum(list(map(len, text if whole.isascii() else map(str.encode, text))))
        at = np.searchsorted(ends, want)
        if ends[-1] != want[-1] or (ends[at] != want).any():
            continue
        raw, cut = ids.tobytes(), [0, *(4 * (at + 1)).tolist()]
        for i, lo, hi in zip(own, cut, cut[1:]):
            out[i] = raw[lo:hi]
    alone = [i for i, x in enumerate(out) if x is None]
    for i, ids in zip(alone, encode([pieces[i] for i in alone]), strict=True):
        out[i] = ids.tobytes()
    return out


class Memo:
    """Piece -> value, made for many new pieces at once by ``make``; ``most`` pieces are remembered."""

    def __init__(self, make: Callable[[list[str]], Iterable], most: int | None = None):
        self.make, self.most, self.known, self.long = make, most or MEMO_PIECES, {}, []

    def look_up(self, texts: list[list[str]]) -> Callable[[str], object]:
        """A function from each piece of ``texts`` to its value."""
        self._forget()
        wanted = set().union(*texts)
        new = wanted - self.known.keys()
        if len(self.known) + len(new) > self.most:
            self.known, new = {}, wanted
        self._learn(list(new))
        return self.known.__getitem__

    def values(self, pieces: list[str]) -> list:
        """The value of each of ``pieces``; no value is None."""
        self._forget()
        out = list(map(self.known.get, pieces))
        gaps = [i for i, x in enumerate(out) if x is None]
        new = list({pieces[i] for i in gaps})
        if len(self.known) + len(new) > self.most:  # the values found are in ``out``
            self.known = {}
        self._learn(new)
        for i in gaps:
            out[i] = self.known[pieces[i]]
        return out

    def clear(self) -> None:
        """Forgets all pieces, and gives the memory of past batches back."""
        self.known, self.long = {}, []
        pa.default_memory_pool().release_unused()

    def _forget(self) -> None:
        """Forgets long pieces, which are kept for one batch only."""
        for k in self.long:
            self.known.pop(k, None)
        self.long = []

    def _learn(self, new: list[str]) -> None:
        if new:
            self.known.update(zip(new, self.make(new), strict=True))
        self.long = [k for k in new if len(k) > MEMO_CHARS]


_loaded: dict[tuple, object] = {}


def once(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` returns, made once in each Python worker."""
    if key not in _loaded:
        _loaded[key] = make()
    return _loaded[key]
